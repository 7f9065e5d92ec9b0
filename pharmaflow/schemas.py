"""Explicit schemas: JSON/CSV sources are read with these, never inferred."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType,
                               StructField, StructType)


def _s(*names, t=StringType()):
    return [StructField(n, t, True) for n in names]


DRUG_LABEL = StructType(_s("brand_name", "manufacturer_name", "product_ndc",
                        t=ArrayType(StringType())))

DRUG = StructType(_s("medicinalproduct", "drugauthorizationnumb")
                  + [StructField("openfda", DRUG_LABEL, True)])

REACTION = StructType(_s("reactionmeddrapt"))

PATIENT = StructType(_s("patientonsetage", "patientsex") + [
    StructField("reaction", ArrayType(REACTION), True),
    StructField("drug", ArrayType(DRUG), True),
])

REPORT = StructType(_s("safetyreportid", "receivedate", "serious")
                    + [StructField("patient", PATIENT, True)])

# A report file is one JSON document {"results": [report, ...]}.
REPORT_FILE = StructType([StructField("results", ArrayType(REPORT), True)])

# Flat safety-event table (output of the report flatten).
EVENT_COLUMNS = ["safetyreportid", "receivedate", "serious", "patientonsetage",
                 "patientsex", "reaction", "medicinalproduct",
                 "drugauthorizationnumb", "brand_name", "manufacturer_name",
                 "product_ndc"]

_CODING = ArrayType(StructType(_s("code", "display")))
_CODE = StructType([StructField("text", StringType(), True),
                    StructField("coding", _CODING, True)])
_REF = StructType(_s("reference"))
_NAMES = ArrayType(StructType([StructField("given", ArrayType(StringType()), True),
                               StructField("family", StringType(), True)]))

# The fields that are read of each resource kind of a bundle.
RESOURCE_FIELDS = {
    "Patient": {"gender": StringType(), "birthDate": StringType(), "name": _NAMES,
                "address": ArrayType(StructType(_s("city", "state")))},
    "Encounter": {"subject": _REF, "period": StructType(_s("start", "end"))},
    "Condition": {"subject": _REF, "onsetDateTime": StringType(), "code": _CODE,
                  "clinicalStatus": StructType([StructField("coding", ArrayType(StructType(_s("code"))), True)])},
    "Observation": {"subject": _REF, "code": _CODE,
                    "valueQuantity": StructType([StructField("value", DoubleType(), True)])},
    "MedicationRequest": {"subject": _REF, "authoredOn": StringType(), "status": StringType(),
                          "medicationCodeableConcept": _CODE},
}


def resource(kinds=None) -> StructType:
    """One struct with the fields of the given resource kinds (all kinds by default)."""
    fields = {"resourceType": StringType(), "id": StringType()}
    for kind in RESOURCE_FIELDS if kinds is None else kinds:
        fields |= RESOURCE_FIELDS[kind]
    return StructType([StructField(n, t, True) for n, t in fields.items()])


def bundle(kinds=None) -> StructType:
    """A bundle's schema; the JSON parser passes over every field that is not in it."""
    return StructType([StructField("entry", ArrayType(StructType(
        [StructField("resource", resource(kinds), True)])), True)])


RESOURCE, BUNDLE = resource(), bundle()

# Patients table as written by the FHIR flow.
PATIENT_ROW = StructType(_s("id", "birthDate", "gender"))

# Runs / model versions tables (experiment log, W5 / M20).
RUNS = StructType(_s("run_id", "experiment", "status", "model_name", "algorithm")
                  + [StructField("start_time", LongType(), True),
                     StructField("end_time", LongType(), True)]
                  + _s("metrics", "params", "tags"))
