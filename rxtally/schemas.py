"""Declared schemas of every stored table. Codes are strings, money is decimal."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


MONEY = T.DecimalType(18, 2)
_STR, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

FACT = _struct(
    ("YEAR_MONTH", _INT),
    ("PRESC_TYPE_PRNT", _STR),
    ("PRESC_ID_PRNT", _LONG),
    ("CALC_PREC_DRUG_RECORD_ID", _LONG),
    ("CALC_AGE", _INT),
    ("PDS_GENDER", _INT),
    ("IDENTIFIED_PATIENT_ID", _LONG),
    ("IDENTIFIED_FLAG", _STR),
    ("ITEM_COUNT", _LONG),
    ("ITEM_PAY_DR_NIC", _LONG),
)

TIME_DIM = _struct(("YEAR_MONTH", _INT), ("FINANCIAL_YEAR", _STR), ("FINANCIAL_QUARTER", _STR))
YEAR_MONTH_DIM = _struct(
    ("YEAR_MONTH", _INT),
    ("FINANCIAL_YEAR", _STR),
    ("FINANCIAL_QUARTER", _STR),
    ("FINANCIAL_QUARTER_EXT", _STR),
)
ORG_DIM = _struct(("LVL_5_OUPDT", _STR), ("LVL_5_OU", _LONG))
DRUG_DIM = _struct(
    ("RECORD_ID", _LONG), ("YEAR_MONTH", _INT), ("BNF_SECTION", _STR), ("SECTION_DESCR", _STR)
)
AGE_DIM = _struct(("AGE", _INT), ("DALL_5YR_BAND", _STR))
DISPENSING_DAYS = _struct(("YEAR_MONTH", _INT), ("DISPENSING_DAYS", _INT))

_PERIOD = [("FINANCIAL_YEAR", _STR), ("FINANCIAL_QUARTER", _STR)]
_SECTION = [("SECTION_NAME", _STR), ("SECTION_CODE", _STR), ("IDENTIFIED_FLAG", _STR)]
_MEASURES = [("ITEM_COUNT", _LONG), ("ITEM_PAY_DR_NIC", MONEY), ("PATIENT_COUNT", _LONG)]

QUARTERLY = _struct(*_PERIOD, *_SECTION, *_MEASURES)
MONTHLY = _struct(*_PERIOD, ("YEAR_MONTH", _INT), *_SECTION, *_MEASURES)
MODEL = _struct(
    *_PERIOD,
    ("YEAR_MONTH", _INT),
    *_SECTION,
    ("PDS_GENDER", _STR),
    ("DALL_5YR_BAND", _STR),
    *_MEASURES,
)

PREDICTIONS = _struct(
    ("SECTION_CODE", _STR),
    ("YEAR_MONTH", _INT),
    ("mean_fit", _DOUBLE),
    ("var", _DOUBLE),
    ("PIlwr", _DOUBLE),
    ("PIupr", _DOUBLE),
    ("PIlwr99", _DOUBLE),
    ("PIupr99", _DOUBLE),
)

INDICATORS = _struct(
    ("SECTION_CODE", _STR),
    ("LINE", _INT),
    ("Section_Name", _STR),
    ("Section_Formatted", _STR),
    ("Period", _STR),
    ("Measure", _STR),
    ("Value", _DOUBLE),
    ("Rounded", _STR),
)
