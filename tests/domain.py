"""Hand-written raw rows that hold the edges the cleaning is for."""

from starquay.schemas import (
    RAW_ARRIVALS,
    RAW_DEMOGRAPHICS,
    RAW_TEMPERATURE,
    REQUIRED_DEMOGRAPHICS,
)

NAN = float("nan")


def rows(schema, records):
    return [tuple(record.get(name) for name in schema.names) for record in records]


def frame(spark, schema, records):
    return spark.createDataFrame(rows(schema, records), schema)


VISITOR = dict(
    cicid=1.0, i94yr=2016.0, i94mon=4.0, i94cit=582.0, i94res=236.0, i94port="NYC",
    arrdate=20574.0, i94mode=1.0, i94addr="NJ", depdate=20580.0, i94bir=30.0, i94visa=2.0,
    count=1.0, biryear=1986.0, gender="F", airline="AA", admnum=92478585633.0, fltno="00012",
    visatype="WT",
)
ARRIVALS = [
    *[VISITOR] * 8,
    VISITOR | dict(cicid=10.0, depdate=None, i94addr=None, i94port="AKR", i94visa=1.0),
    VISITOR | dict(cicid=9.0, arrdate=NAN, i94addr="99", i94port="???", visatype="B2"),
    VISITOR | dict(cicid=2.0, arrdate=-0.5, depdate=20574.9, gender=None, i94visa=None),
    {},
    dict(occup="STU"),
]
MONTH = dict(dt="2013-01-01", AverageTemperature="-3.5", City="Akron", Country="United States")
TEMPERATURES = [
    MONTH | dict(AverageTemperatureUncertainty="0.2"),
    MONTH | dict(AverageTemperature="-20", AverageTemperatureUncertainty="0.9"),
    MONTH | dict(dt="1743-11-01", AverageTemperature="3.2", City="akron"),
    MONTH | dict(dt="2013-02-01", AverageTemperature=None),
    MONTH | dict(dt="2013-02-01", AverageTemperature="7.0", City="Oslo", Country="Norway"),
    MONTH | dict(dt="soon", AverageTemperature="warm"),
    MONTH | dict(dt="2013-03-01", AverageTemperature="20.5", City="Homer"),
]
TOWN = {
    "City": "Silver Spring", "State": "Maryland", "Median Age": "33.8", "Male Population": "40601",
    "Female Population": "41862", "Total Population": "82463", "Number of Veterans": "1562",
    "Foreign-born": "30908", "Average Household Size": "2.6", "State Code": "MD", "Race": "White",
    "Count": "37756",
}
RACES = ["White", "Asian", "Black", "Native", "Other"]
DEMOGRAPHICS = [
    *(TOWN | {"Race": race, "Count": str(n)} for n, race in enumerate(RACES)),
    TOWN | {"Count": "99"},
    TOWN | {"City": "Akron", "Median Age": None, "Male Population": "7"},
    *(TOWN | {"City": "Gap", column: None} for column in REQUIRED_DEMOGRAPHICS),
]
LABELS = """  value i94cntyl\r
   582 =  'LOWER NOWHERE'\r
   236 =  'UPPER NOWHERE' ;\r
  value $i94prtl\r
   'NYC'\t=\t'EASTPORT, ZZ   '\r
   'AKR'\t=\t'AKRON, ZZ   '\r
   'CAK'\t=\t'AKRON, ZZ   '\r
;\r
value i94addrl\r
\t'NJ'='EASTMARCH'\r
\t'99'='ANYWHERE ELSE' ;\r
"""


def arrivals(spark):
    return frame(spark, RAW_ARRIVALS, ARRIVALS).repartition(3)


def temperatures(spark):
    return frame(spark, RAW_TEMPERATURE, TEMPERATURES)


def demographics(spark):
    return frame(spark, RAW_DEMOGRAPHICS, DEMOGRAPHICS)


def labels(spark):
    return spark.createDataFrame([("a", LABELS)], "file string, text string")
