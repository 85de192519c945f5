"""Clinical code profiles for the test views.

Each spell gets one profile by ``order key % PROFILE_COUNT``. A profile is ``diagnoses|procedures``, in
code order (the first is primary). For every cohort condition there is a profile that meets it and
one that just misses it. Profiles past the end of the list get generic codes instead.
"""

PROFILE_COUNT = 160

PROFILES = [
    # alcohol, wholly attributable: hit, near miss
    "J189 E244|", "J189 E243|",
    # ambulatory care, acute: cellulitis with and without a procedure, gangrene, other groups
    "L031|", "L031|S101", "L031|S491", "I10X R02X|", "K529|", "G408|", "A690|", "H669|", "N739|", "K253|", "N12X|", "N13X|",
    # ambulatory care, chronic: angina with and without a procedure, and the other conditions
    "I209|", "I209|K401", "I209|X301", "J459|", "I501|", "I110|K561", "J81X|K581", "J440|", "J209 J441|", "J209 R101|",
    "R104 E119|", "D508|", "E43X|", "E640|",
    # vaccine preventable
    "J13X|", "J13X D571|", "R101 A369|", "R101 A389|",
    # external causes
    "S720 W010|", "S720 W210|", "M484 R101|", "M484 V011|", "R296|", "S011 X709|", "S011 Y870|", "S011 X990|",
    # evidence-based interventions: ear, nose and throat
    "H652|E201 D151", "H652 G473|E201 D151", "H660|D151", "H650|D151", "R065|F325", "R065 G473|F325",
    "J310|E121 Y761", "J310|E121 Y781", "J350|F341", "J350 J390|F341",
    # general surgery and gastroenterology
    "R101|H011", "K352|H011", "K851|J181", "K852|J181", "K649|H511", "K649|H514", "K402|T201", "K409|T211",
    "R194|H221", "D126|H221", "R194|H221 H681", "R101|G161", "R101|G163", "R101|G164",
    # musculoskeletal
    "M232|W821", "M232 S832|W821", "M233 M238|W714 Y767 Z846", "M233|W714 Y767 Z846",
    "M754|O291 Y767", "M754 M751|O291 Y767", "M754|W572 Z812", "M545|A521", "M544|A521",
    "M720|T521", "M720|T523", "M545|V382", "M545 M401|V382", "M545 O268 M533|V382", "M545 O268|V382",
    "M255 M258|T591", "M255|T591", "M171|W851", "M171|W802 Y767 Z846", "M171 M238|W851",
    "M511|V331", "M511|V521 Z993", "M511|V521", "M512 Z675|V485", "M512|V485", "M653|T691", "M652|T691", "M800|V444", "M810|V444",
    # urology and vascular
    "R101 F171|M455", "R101 F171|M455 M451", "N40X|M611", "N40X N130|M611", "I839|L841", "I839|L847",
    # medicines
    "R101 Y401|", "R101 Y581|", "E161 E119|", "E161 E119 Y401|", "R55X F101|", "W011 F101|", "I470 I10X|", "K250 M060|", "K251 M060|",
    # obesity, smoking, mental health, virtual wards, heart failure
    "C180|", "C189|", "C340|", "A150|", "F200|", "F200|A011", "J101|", "J101|A011", "I500|", "I502|", "R101|",
    # elective recovery
    "R101|M341", "R101|B271", "R101|H051", "R101|W371", "R101|Q071", "R101|W401", "R101|M611", "R101|H331", "R101|H337",
    # same-day care and frailty
    "I801|", "I269|", "F001 G301 W191|", "R410 N390 E860|", "I64X R296 F051 S064|",
]


def code_rows(part: int) -> list[tuple[int, int, str]]:
    """(profile, order, code) rows for the diagnoses (part 0) or the procedures (part 1)."""
    return [
        (profile, order, code)
        for profile, text in enumerate(PROFILES)
        for order, code in enumerate(text.split("|")[part].split(), start=1)
    ]


def values_sql(part: int) -> str:
    """The same rows as an SQL VALUES list."""
    return ", ".join(f"({p}, {o}, '{c}')" for p, o, c in code_rows(part))
