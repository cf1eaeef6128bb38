"""Case type from free text: the first of an ordered list of patterns wins."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.functions.text import col, nonblank

# The labels and their patterns, in match order.
CASE_TYPES: list[tuple[str, str]] = [
    ("habeas_corpus", r"habeas corpus|\bh\.?c\.?p\b"),
    ("pil", r"public interest litigation|\bpil\b"),
    ("letters_patent_appeal", r"letters patent|\blpa\b"),
    ("special_leave_petition", r"\bslp\b|special leave"),
    ("anticipatory_bail", r"anticipatory bail|\b438\b"),
    ("cancellation_of_bail", r"cancellation of bail|cancel(?:ling|lation)? .{0,20}bail"),
    ("bail_application", r"bail application|regular bail|\bbail\b|\b439\b"),
    ("quashing_petition", r"quash|\b482\b|\b528 bnss\b"),
    ("transfer_petition", r"transfer petition|\bt\.?p\.?\(|transfer application"),
    ("revision_petition",
     r"revision petition|criminal revision|civil revision|crl\.? ?rev|\bcrr\b|\bcrp\b"),
    ("writ_petition", r"\bw\.?p\b|\bwp\(|writ petition|art(?:icle)?\.? ?226"),
    ("criminal_appeal", r"crl\.? ?a|criminal appeal|cr\.?a\b"),
    ("second_appeal", r"second appeal|\brsa\b|\bsa\("),
    ("first_appeal", r"first appeal|\brfa\b|\bfao\b|\bfa\b"),
    ("civil_appeal", r"\bc\.?a\b|civil appeal"),
    ("review_petition", r"review petition|\brp\(|\br\.?p\.?\b"),
    ("contempt_petition", r"contempt"),
    ("arbitration", r"arbitration|\barb\b|a&c|arb\.? ?p"),
    ("tax_matter", r"income tax|\bitr\b|\bita\b|sales tax|\bgst\b|vat|excise|customs"),
    ("corruption_case", r"prevention of corruption|\bpc act\b|corruption|\bcbi\b"),
    ("departmental_inquiry",
     r"departmental (?:inquiry|enquiry)|charge ?sheet|disciplinary (?:inquiry|enquiry)"),
    ("disciplinary_proceeding", r"disciplinary"),
    ("service_matter",
     r"\boa\b|service matter|original application|\bcat\b|promotion|seniority|pension"),
    ("company_petition", r"company petition|companies act|\bc\.?p\.?\("),
    ("insolvency_proceedings",
     r"insolvency|bankrupt|\bibc\b|\bnclt\b|\bcirp\b|liquidation"),
    ("execution_petition", r"execution (?:petition|application|case)|\be\.?p\.?\("),
    ("commercial_suit", r"commercial (?:suit|dispute|court)"),
    ("consumer_complaint", r"consumer|\bncdrc\b|\bscdrc\b"),
    ("election_petition", r"election petition|representation of the people"),
    ("motor_accident_claim",
     r"motor accident|\bmact\b|motor vehicles act|claim petition"),
    ("land_acquisition", r"land acquisition|\blar\b"),
    ("divorce_petition", r"divorce|dissolution of marriage"),
    ("matrimonial_matter",
     r"matrimonial|hindu marriage act|\bhma\b|maintenance|\b125 cr"),
    ("eviction_suit", r"eviction|rent control|\brca\b"),
    ("suit_for_partition", r"partition"),
    ("suit_for_specific_performance", r"specific performance"),
    ("suit_for_injunction", r"injunction"),
    ("suit_for_declaration", r"(?:suit|decree) for declaration|declaratory"),
    ("suit_for_recovery",
     r"(?:suit|decree) for recovery|recovery suit|money suit"),
    ("trial", r"sessions (?:trial|case)|\bs\.?c\.? no"),
    ("miscellaneous_petition", r"miscellaneous|\bmisc\b"),
]

# Unicode word boundaries, and only a line feed ends a line.
_FLAGS = "(?Ud)"

# Letters that case-insensitive matching treats as plain s and i, besides lower-casing.
_FOLD_FROM, _FOLD_TO = "\u017f\u0131\u0130\u212a", "siik"


def fold(text: Column | str) -> Column:
    """Lower-case form on which the patterns match without a case-insensitive flag."""
    return F.lower(F.translate(col(text), _FOLD_FROM, _FOLD_TO))


def vocabulary(folded: Column | str) -> Column:
    """The distinct words of a folded text, each between single blanks.

    A single word, bounded or not, is a substring of this exactly when the text has it, and
    a long text repeats its words: searching here costs much less than searching the text.
    """
    words = F.split(F.regexp_replace(col(folded), r"(?U)[^\w]+", " "), " ")
    return F.concat(F.lit(" "), F.concat_ws(" ", F.array_distinct(words)), F.lit(" "))


_OPTIONAL = r"\(\?:([^()]*)\)\?|(\\.|[a-z ])\?"
_GROUP = r"\(\?:([^()]*)\)"


def _spellings(piece: str) -> list[str]:
    """``piece`` with its optional parts and groups written out."""
    found = re.search(f"{_OPTIONAL}|{_GROUP}", piece)
    if not found:
        return [piece]
    optional, atom, group = found.groups()
    options = [atom, ""] if atom else (optional or group).split("|") + [""] * bool(optional)
    head, tail = piece[: found.start()], piece[found.end():]
    return [s for o in options for s in _spellings(head + o + tail)]


def _has(text: str) -> str:
    return f"contains(_vocab, '{text}')"


def _hint(text: str) -> str:
    """SQL condition, on the vocabulary alone, that every occurrence of ``text`` fulfils."""
    return _has(max(re.findall(r"[a-z0-9]+", text), key=len))


def _hints(piece: str) -> list[str]:
    """Conditions of which one holds wherever ``piece`` matches.

    The longest fixed run when it is long enough to be rare, else the words of every spelling.
    """
    runs = re.split(r"\(\?:[^()]*\)\??|(?:\\.|[a-z ])\?|\.\{.*|\\.", piece)
    longest = max(runs, key=lambda r: len(r.strip()))
    if len(longest.strip()) >= 3:
        return [_hint(longest)]
    spelled = [
        re.sub(r"[^a-z0-9]+", " ", s.replace(r"\b", " ").replace("\\", ""))
        for s in _spellings(piece)
    ]
    return [" AND ".join(_has(w) for w in re.findall(r" ?[a-z0-9]+ ?", s.replace(" ", "  ")))
            for s in dict.fromkeys(spelled)]


def condition(pattern: str) -> str:
    """SQL condition that ``pattern`` occurs in _blob, given its vocabulary _vocab.

    Words and fixed texts are substring searches, a fraction of the cost of a regex scan.
    What remains runs as a regex, and only where its words are present.
    """
    arms, hints, regex = [], [], []
    for piece in re.split(r"\|(?![^(]*\))", pattern):
        word = re.fullmatch(r"\\b([a-z0-9]+)\\b", piece)
        if re.fullmatch(r"[a-z0-9]+", piece):
            arms.append(_has(piece))
        elif word:
            arms.append(_has(f" {word[1]} "))
        elif re.fullmatch(r"[a-z0-9& ]+", piece):
            arms.append(f"({_hint(piece)} AND contains(_blob, '{piece}'))")
        else:
            regex.append(piece)
            hints += _hints(piece)
    if regex:
        any_hint = " OR ".join(f"({h})" for h in hints)
        arms.append(f"(({any_hint}) AND _blob RLIKE r'{_FLAGS}{'|'.join(regex)}')")
    return " OR ".join(arms)


def case_type() -> Column:
    """Label of the first pattern found, over the columns _blob and _vocab; NULL without one.

    Written as one SQL expression, which is parsed at once; some hundred Column calls would
    each cross into the JVM.
    """
    arms = " ".join(f"WHEN {condition(p)} THEN '{label}'" for label, p in CASE_TYPES)
    return F.expr(f"CASE {arms} END")


def with_case_type(df: DataFrame, out: str, *texts: Column | str) -> DataFrame:
    """Add the case type of the non-empty ``texts`` joined by a blank.

    The folded text and its vocabulary get projections of their own, which Catalyst keeps apart
    because the pattern chain reads them many times.
    """
    blob = fold(F.concat_ws(" ", *[nonblank(t) for t in texts]))
    return (
        df.select("*", blob.alias("_blob")).select("*", vocabulary("_blob").alias("_vocab"))
        .select(*df.columns, case_type().alias(out))
    )
