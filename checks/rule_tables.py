"""Short rule tables for the checks, in the shapes of the published files (made-up numbers)."""

ALCOHOL = {
    "ages": [16, 25, 35, 45, 55, 65, 75, 85],
    "data": {
        "chronic": {
            "Cancer": {"Colorectal": {"regex": "C1[89]", "male": [0.1] * 4 + [0.25] * 4, "female": [0.05] * 7 + [1.5]}},
            "Other": {
                "Hypertension": {
                    "mortality": {"regex": "I1[0-5]", "male": [0.3] * 8, "female": [-0.1] * 4 + [0.2] * 4},
                    "morbidity": {"regex": "I1[0-5]", "male": [0.15] * 8, "female": [0.125] * 8},
                },
                "Any I1": {"regex": "I1", "male": [0.01] * 8},
            },
        },
        "acute": {
            "Injuries": {
                "Falls": {"regex": "W(0|1[0-9])", "male": [0.35] * 8, "female": [0.15] * 8},
                "Fractures": {"regex": "S[37]2", "male": [0.5, 0, 0.5, 0, 0.5, 0, 0.5, 0], "female": [0.4] * 8},
            }
        },
    },
}

SMOKING = [
    {"pattern": "C34", "sex": "1", "rate": 0.8},
    {"pattern": "C34", "sex": "2", "rate": 0.75},
    {"pattern": "C3", "sex": "1", "rate": 0.25},
    {"pattern": "J4[0-4]", "sex": "1", "rate": 0.5},
    {"pattern": "J4[0-4]", "sex": "2", "rate": 0.625},
    {"pattern": "A1[5-9]", "sex": "2", "rate": 0.125},
]

SDEC = {
    "Medicine": {
        "Thrombosis": {"group": "very high", "hrg_codes": ["YQ51[CDE]", "DZ.*"], "icd10_codes": ["I80[123]", "J.*"]},
        "Embolism": {"group": "high", "hrg_codes": ["DZ09[NPQ]", "DZ11A", "HN12B"], "icd10_codes": ["I26[09]", "[A-F][0-9]{2,3}X?"]},
        "Asthma": {"group": "moderate", "hrg_codes": ["EB03[A-E]", "AA22C"], "icd10_codes": ["[J-K]..[0-9]"]},
    },
    "Surgery": {"Other": {"group": "low", "hrg_codes": ["JC42C", "AA35A"], "icd10_codes": ["[L-Z]...?"]}},
}

FRAILTY = [
    ("F00", 7.1), ("G30", 4.0), ("W19", 3.2), ("R29", 3.6), ("R41", 2.7), ("N39", 3.2), ("E86", 2.3), ("I64", 2.6),
    ("F05", 3.2), ("S06", 2.4), ("E11", 1.1), ("J01", 2.9), ("K02", 0.8), ("M03", 1.6), ("G04", 5.2), ("Z05", 4.4),
]


def alcohol_rows(group: str) -> list[dict]:
    """The alcohol fractions of one group as rows, for the oracle."""
    lows = ALCOHOL["ages"]
    rows = []
    for family in ALCOHOL["data"][group].values():
        for entry in family.values():
            for outcome in ("mortality", "morbidity"):
                given = entry.get(outcome) if "mortality" in entry else entry
                for sex, name in enumerate(("male", "female"), 1):
                    for k, rate in enumerate((given or {}).get(name, [])):
                        if 0 < rate <= 1:
                            high = lows[k + 1] - 1 if k + 1 < len(lows) else None
                            rows.append(dict(pattern=given["regex"], sex=str(sex), outcome=outcome, low=lows[k], high=high, rate=rate))
    return rows


def sdec_rows() -> list[dict]:
    """The directory's entries as rows of whole-code patterns, for the oracle."""
    return [
        {"level": c["group"], "hrg": f"^({'|'.join(c['hrg_codes'])})$", "icd10": f"^({'|'.join(c['icd10_codes'])})$"}
        for specialty in SDEC.values()
        for c in specialty.values()
    ]
