"""Corpus ingestion and ledger operators expressed as Spark DataFrame jobs."""
