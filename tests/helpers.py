"""Small star-schema literals for edge cases."""

from rxtally import schemas
from rxtally.operators import joins

TIME = [
    (202210, "2022/2023", "2022/2023 Q3"),
    (202211, "2022/2023", "2022/2023 Q3"),
    (202212, "2022/2023", "2022/2023 Q3"),
    (202301, "2022/2023", "2022/2023 Q4"),
]
ORG = [("S", 1), ("S", 2)]
AGE = [(-1, None), (7, "05-09"), (42, "40-44"), (95, "90+")]


def item(month=202210, org=1, drug=10, age=42, gender=1, patient=100, flag="Y", n=1, pence=250):
    return (month, "S", org, drug, age, gender, patient, flag, n, pence)


def drugs():
    months = [row[0] for row in TIME]
    return [(10, m, "0403", "Antidepressant drugs") for m in months] + [
        (11, m, "0401", "Hypnotics and anxiolytics") for m in months
    ]


def dims(spark):
    return (
        spark.createDataFrame(TIME, schemas.TIME_DIM),
        spark.createDataFrame(ORG, schemas.ORG_DIM),
        spark.createDataFrame(drugs(), schemas.DRUG_DIM),
        spark.createDataFrame(AGE, schemas.AGE_DIM),
    )


def facts(spark, rows):
    return spark.createDataFrame(rows, schemas.FACT)


def star(spark, rows):
    time, org, drug, age = dims(spark)
    return joins.star_join(facts(spark, rows), time, org, drug, age), time
