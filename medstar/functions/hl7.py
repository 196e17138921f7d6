"""Header and patient-fact fields of an HL7 v3 clinical document.

The paths are data: a different document type (e.g. a department one level
deeper in the organisation chain) is a different ``Field`` list, not new
code.
"""

from __future__ import annotations

from .xml_paths import (Field, Reject, jchar_at, jdiv, jdrop, jparse_int,
                        jprefix)

# ---- fixed values: paths and constants the results depend on ------------
# Header cells of the wide document table (family, qualifier, path).
HEADER_PATHS = [
    ("row_key", "id/@extension"),
    ("id", "id/@root"),
    ("typeCode", "code/@code"),
    ("effectiveTime", "effectiveTime/@value"),
    ("title", "title"),
    ("realmCode", "realmCode/@code"),
    ("languageCode", "languageCode/@code"),
]
# Patient fact paths.
ID_CARD_PATH = "recordTarget/patientRole/patient/id/@extension"
GENDER_PATH = "recordTarget/patientRole/patient/administrativeGenderCode/@code"
AGE_PATH = "recordTarget/patientRole/patient/age/@value"
COUNTY_PATH = "recordTarget/patientRole/addr/county"
CITY_PATH = "recordTarget/patientRole/addr/city"
IN_TIME_PATH = "componentOf/encompassingEncounter/effectiveTime/low/@value"
IN_CLASS_PATH = ("componentOf/encompassingEncounter/location/healthCareFacility/"
                 "serviceProviderOrganization/asOrganizationPartOf/wholeOrganization/"
                 "asOrganizationPartOf/wholeOrganization/id/@extension")
MAIN_DOC_PATH = "//authenticator/assignedEntity/id/@extension"
OUT_SICK_PATH = ("component/structuredBody//component/section//entry/observation/"
                 "code/qualifier/name/@displayName")
ID_CARD_PREFIX_LEN = 2      # characters dropped from the patient id
AGE_BAND_WIDTH = 10         # age -> age band id by integer division
MONTH_KEY_LEN = 6           # yyyyMM prefix of the admission time
ATTENDING_CHAR_POS = 2      # 0-based position of the role character ...
ATTENDING_CHAR = "2"        # ... that marks the attending doctor
DISEASE_PREFIX = "JB"       # discharge-diagnosis names start with this
# Row-key range of inpatient records: [start, end) in byte order.
INPATIENT_RANGE = ("RN32_001", "RN33_001")
# The patient fact, in this column order.
FACT_COLUMNS = ["idCard", "genderId", "ageId", "addr", "inTimeId",
                "inClassId", "mainDocId", "outSickId"]
# ---------------------------------------------------------------------------

HEADER_FIELDS = [
    Field(name, path, mode="text" if name == "title" else "head")
    for name, path in HEADER_PATHS
]


def _attending(node, what: str) -> bool:
    ext = node.attrib.get("extension", "")
    return jchar_at(ext, ATTENDING_CHAR_POS, what) == ATTENDING_CHAR


def _disease(node, what: str) -> bool:
    name = node.attrib.get("displayName")
    if name is None:
        return False
    return jprefix(name, len(DISEASE_PREFIX), what) == DISEASE_PREFIX


def _age_band(value: str) -> str:
    return str(jdiv(jparse_int(value, "ageId"), AGE_BAND_WIDTH))


def _month_key(value: str) -> str:
    return jprefix(value, MONTH_KEY_LEN, "inTimeId")


# Evaluation order decides which reason a document with several faults gets.
FACT_FIELDS = [
    Field("idCard", ID_CARD_PATH, post=lambda v: jdrop(v, ID_CARD_PREFIX_LEN)),
    Field("genderId", GENDER_PATH),
    Field("ageId", AGE_PATH, post=_age_band),
    Field("_county", COUNTY_PATH, mode="first_text"),
    Field("_city", CITY_PATH, mode="first_text"),
    Field("inTimeId", IN_TIME_PATH, mode="text", post=_month_key),
    Field("inClassId", IN_CLASS_PATH),
    Field("mainDocId", MAIN_DOC_PATH, mode="text", node_filter=_attending),
    Field("outSickId", OUT_SICK_PATH, node_filter=_disease),
]

__all__ = ["HEADER_FIELDS", "FACT_FIELDS", "FACT_COLUMNS", "INPATIENT_RANGE",
           "Reject"]
