"""Court codes: official names and states."""

from __future__ import annotations

# Code -> official name.
COURT_NAMES = {
    "9_13": "Allahabad High Court",
    "27_1": "Bombay High Court",
    "19_16": "Calcutta High Court",
    "18_6": "Gauhati High Court",
    "36_29": "High Court for State of Telangana",
    "28_2": "High Court of Andhra Pradesh",
    "22_18": "High Court of Chhattisgarh",
    "7_26": "High Court of Delhi",
    "24_17": "High Court of Gujarat",
    "2_5": "High Court of Himachal Pradesh",
    "1_12": "High Court of Jammu and Kashmir",
    "20_7": "High Court of Jharkhand",
    "29_3": "High Court of Karnataka",
    "32_4": "High Court of Kerala",
    "23_23": "High Court of Madhya Pradesh",
    "14_25": "High Court of Manipur",
    "17_21": "High Court of Meghalaya",
    "21_11": "High Court of Orissa",
    "3_22": "High Court of Punjab and Haryana",
    "8_9": "High Court of Rajasthan",
    "11_24": "High Court of Sikkim",
    "16_20": "High Court of Tripura",
    "5_15": "High Court of Uttarakhand",
    "33_10": "Madras High Court",
    "10_8": "Patna High Court",
}

# Code -> state.
COURT_STATES = {
    "9_13": "Uttar Pradesh",
    "27_1": "Maharashtra",
    "19_16": "West Bengal",
    "18_6": "Assam",
    "36_29": "Telangana",
    "28_2": "Andhra Pradesh",
    "22_18": "Chhattisgarh",
    "7_26": "Delhi",
    "24_17": "Gujarat",
    "2_5": "Himachal Pradesh",
    "1_12": "Jammu and Kashmir",
    "20_7": "Jharkhand",
    "29_3": "Karnataka",
    "32_4": "Kerala",
    "23_23": "Madhya Pradesh",
    "14_25": "Manipur",
    "17_21": "Meghalaya",
    "21_11": "Odisha",
    "3_22": "Punjab and Haryana",
    "8_9": "Rajasthan",
    "11_24": "Sikkim",
    "16_20": "Tripura",
    "5_15": "Uttarakhand",
    "33_10": "Tamil Nadu",
    "10_8": "Bihar",
}
