"""Code sets that drive the oncology classifiers.

Code lists are data: each classifier takes a ``{label: codes}`` mapping (turned into a
CASE over hashed IN-sets, evaluated inside whole-stage codegen) or a dimension DataFrame
(joined with a broadcast hint; the lists below are bounded by construction).
"""
from __future__ import annotations


# ---------------------------------------------------------------------------------------
# FIXED VALUES — must equal the reference's code lists for right results.
# Kept verbatim, in the reference's own order.
# ---------------------------------------------------------------------------------------

# Office-visit (evaluation and management) procedure codes.
OFFICE_VISIT_CODES = (
    "99201", "99202", "99203", "99204", "99205", "99211", "99212", "99213", "99214", "99215",
    "99241", "99242", "99243", "99244", "99245", "99251", "99252", "99253", "99254", "99255",
    "99221", "99222", "99223", "99231", "99232", "99233",
)

# Radiation-oncology treatment procedure codes (146).
TREATMENT_CODES = (
    "77261", "77262", "77263", "77280", "77281", "77282", "77283", "77284", "77285", "77286",
    "77287", "77288", "77289", "77290", "77293", "77295", "77300", "77301", "77306", "77307",
    "77316", "77317", "77318", "77321", "77331", "77332", "77333", "77334", "77336", "77338",
    "77370", "77401", "77402", "77407", "77412", "G6003", "G6004", "G6005", "G6006", "G6007",
    "G6008", "G6009", "G6010", "G6011", "G6012", "G6013", "G6014", "77385", "77386", "G6015",
    "G6016", "77417", "77387", "G6001", "G6002", "G6017", "77014", "77520", "77521", "77522",
    "77523", "77524", "77525", "77422", "77423", "77373", "77372", "77600", "77601", "77602",
    "77603", "77604", "77605", "77606", "77607", "77608", "77609", "77610", "77611", "77612",
    "77613", "77614", "77615", "77616", "77617", "77618", "77619", "77620", "77778", "77770",
    "77772", "0394T", "0395T", "77424", "77425", "77789", "77750", "77761", "77762", "77763",
    "77790", "77427", "77431", "77432", "77435", "77469", "77470", "77767", "77768", "77771",
    "77371", "G0339", "G0340", "19294", "A9609", "79101", "79005", "79403", "A9512", "A9543",
    "A9590", "A9595", "A9606", "A9607", "A9699", "19296", "19297", "19298", "31643", "32553",
    "41019", "49411", "49412", "55875", "55876", "55920", "57155", "57156", "58346", "76873",
    "76965", "61796", "61797", "61798", "61799", "61800",
)

# Treatment-process stage by procedure code; the first matching stage wins.
STAGE_CODES = {
    "1-Consultation": OFFICE_VISIT_CODES,
    "2-Simulation": (
        "77261", "77262", "77263", "77280", "77281", "77282", "77283", "77284", "77285",
        "77286", "77287", "77288", "77289", "77290", "77293",
    ),
    "3-Planning": (
        "77295", "77300", "77301", "77306", "77307", "77316", "77317", "77318", "77321",
        "77331", "77332", "77333", "77334", "77336", "77338", "77370",
    ),
    "4-Radiation": (
        "77401", "77402", "77407", "77412", "G6003", "G6004", "G6005", "G6006", "G6007",
        "G6008", "G6009", "G6010", "G6011", "G6012", "G6013", "G6014", "77385", "77386",
        "G6015", "G6016", "77417", "77387", "G6001", "G6002", "G6017", "77014", "77520",
        "77521", "77522", "77523", "77524", "77525", "77422", "77423", "77373", "77372",
        "77600", "77601", "77602", "77603", "77604", "77605", "77606", "77607", "77608",
        "77609", "77610", "77611", "77612", "77613", "77614", "77615", "77616", "77617",
        "77618", "77619", "77620", "77778", "77770", "77772", "0394T", "0395T", "77424",
        "77425", "77789", "77750", "77761", "77762", "77763", "77790",
    ),
    "5-Management": ("77427", "77431", "77432", "77435", "77469", "77470"),
}

# Body area by ICD-10 diagnosis code.
BODY_AREA_CODES = {
    "breast": (
        "C500", "C5001", "C50011", "C50012", "C50019", "C5002", "C50021", "C50022", "C50029",
        "C501", "C5011", "C50111", "C50112", "C50119", "C5012", "C50121", "C50122", "C50129",
        "C502", "C5021", "C50211", "C50212", "C50219", "C5022", "C50221", "C50222", "C50229",
        "C503", "C5031", "C50311", "C50312", "C50319", "C5032", "C50321", "C50322", "C50329",
        "C504", "C5041", "C50411", "C50412", "C50419", "C5042", "C50421", "C50422", "C50429",
        "C505", "C5051", "C50511", "C50512", "C50519", "C5052", "C50521", "C50522", "C50529",
        "C506", "C5061", "C50611", "C50612", "C50619", "C5062", "C50621", "C50622", "C50629",
        "C508", "C5081", "C50811", "C50812", "C50819", "C5082", "C50821", "C50822", "C50829",
        "C509", "C5091", "C50911", "C50912", "C50919", "C5092", "C50921", "C50922", "C50929",
    ),
    "lung": (
        "C340", "C3400", "C3401", "C3402", "C341", "C3410", "C3411", "C3412", "C342", "C343",
        "C3430", "C3431", "C3432", "C348", "C3480", "C3481", "C3482", "C349", "C3490", "C3491",
        "C3492",
    ),
    "skin": (
        "C4A0", "C4A1", "C4A10", "C4A11", "C4A111", "C4A112", "C4A12", "C4A121", "C4A122",
        "C4A2", "C4A20", "C4A21", "C4A22", "C4A3", "C4A30", "C4A31", "C4A39", "C4A4", "C4A5",
        "C4A51", "C4A52", "C4A59", "C4A6", "C4A60", "C4A61", "C4A62", "C4A7", "C4A70", "C4A71",
        "C4A72", "C4A8", "C4A9", "C430", "C431", "C4310", "C4311", "C43111", "C43112", "C4312",
        "C43121", "C43122", "C432", "C4320", "C4321", "C4322", "C433", "C4330", "C4331",
        "C4339", "C434", "C435", "C4351", "C4352", "C4359", "C436", "C4360", "C4361", "C4362",
        "C437", "C4370", "C4371", "C4372", "C438", "C439", "C440", "C4400", "C4401", "C4402",
        "C4409", "C441", "C4410", "C44101", "C44102", "C441021", "C441022", "C44109",
        "C441091",
    ),
    "prostate": ("C61",),
}

# Radiation modality by procedure code.
MODALITY_CODES = {
    "Brachytherapy": ("77767", "77768", "77770", "77771", "77772"),
    "IMRT": ("G6015", "77385", "77386", "G6016"),
    "SBRT": ("77373",),
    "3D": ("G6012", "G6013"),
}

# Modality priority inside one treatment course; every other label ranks 5.
MODALITY_PRIORITY = {"IMRT": 1, "SBRT": 2, "3D": 3}
OTHER_MODALITY_RANK = 5

UNKNOWN = "Unknown"
# ---------------------------------------------------------------------------------------

# Procedure codes kept on claim lines: office visits plus treatments (172).
LINE_CODES = OFFICE_VISIT_CODES + TREATMENT_CODES
