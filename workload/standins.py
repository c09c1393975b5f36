"""The given tables in the shapes the library works on.

Raw shapes are made from whole tables, with the flaws that cleaning is for: copies,
rows without a value, NaN, NULL, and everything as text where a CSV has text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starquay.functions.columns import named
from starquay.plans.load import RawFrames
from starquay.schemas import RAW_ARRIVALS, RAW_DEMOGRAPHICS, RAW_TEMPERATURE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Raw arrival column -> expression over orders. Columns left out are NULL.
_ARRIVALS = {
    "cicid": "cast(o_orderkey as double)",
    "i94yr": "cast(year(o_orderdate) as double)",
    "i94mon": "cast(month(o_orderdate) as double)",
    "i94cit": "cast(o_custkey as double)",
    "i94res": "cast(pmod(o_custkey, 25) as double)",
    "i94port": "concat('P', pmod(o_custkey, 25))",
    "arrdate": "datediff(o_orderdate, date'1960-01-01') + 0.25D",
    "i94mode": "case o_orderstatus when 'O' then 1D when 'F' then 2D else 3D end",
    "i94addr": "case when o_orderpriority <> '5-LOW' then left(o_orderpriority, 1) end",
    "depdate": "case o_orderstatus when 'O' then datediff(o_orderdate, date'1960-01-01') + 10.5D"
    " when 'P' then double('NaN') end",
    "i94visa": "case o_orderstatus when 'O' then 2D when 'F' then 1D else 3D end",
    "count": "1D",
    "entdepa": "'A'",
    "matflag": "case when o_orderstatus = 'O' then 'M' end",
    "biryear": "cast(1900 + pmod(o_custkey, 100) as double)",
    "gender": "case o_orderstatus when 'O' then 'F' when 'F' then 'M' end",
    "airline": "o_orderpriority",
    "admnum": "cast(o_orderkey * 1000003 + 5000000000 as double)",
    "fltno": "concat('F', o_custkey)",
    "visatype": "concat('B', o_orderstatus)",
}


def raw_arrivals(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Orders as raw arrivals; urgent ones twice, and a row of NULLs after each of
    high priority."""
    source = table(spark, sf_dir, "orders") if orders is None else orders
    copies = F.expr(
        "explode(case o_orderpriority when '1-URGENT' then array(true, true)"
        " when '2-HIGH' then array(true, false) else array(true) end)"
    )
    rows = source.withColumn("filled", copies)
    return rows.select(
        *(
            F.when(F.col("filled"), F.expr(_ARRIVALS.get(field.name, "null")))
            .cast(field.dataType)
            .alias(field.name)
            for field in RAW_ARRIVALS
        )
    )


# Raw temperature column -> expression over events.
_TEMPERATURE = {
    "dt": "cast(cast(ts as date) as string)",
    "AverageTemperature": "case when value <= 95 then cast(value as string) end",
    "AverageTemperatureUncertainty": "cast(event_id as string)",
    "City": "concat('city ', user_id)",
    "Country": "case event_type when 'purchase' then 'United States' else event_type end",
}

# Raw demographic column -> expression over lineitem.
_DEMOGRAPHICS = {
    "City": "concat('Part ', l_partkey)",
    "State": "concat('state ', l_linestatus)",
    "Median Age": "cast(l_quantity as string)",
    "Male Population": "cast(l_quantity as string)",
    "Female Population": "cast(l_extendedprice as string)",
    "Number of Veterans": "case when l_discount > 0 then cast(l_linenumber as string) end",
    "Foreign-born": "cast(l_suppkey as string)",
    "Average Household Size": "cast(l_tax as string)",
    "State Code": "l_linestatus",
    "Race": "l_returnflag",
    "Count": "concat(l_orderkey, '-', l_linenumber)",
}


def _shaped(source: DataFrame, schema, expressions: dict[str, str]) -> DataFrame:
    return source.select(
        *(
            F.expr(expressions.get(f.name, "null")).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def raw_temperature(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    source = table(spark, sf_dir, "events") if events is None else events
    return _shaped(source, RAW_TEMPERATURE, _TEMPERATURE)


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(table(spark, sf_dir, "lineitem"), RAW_DEMOGRAPHICS, _DEMOGRAPHICS)


# A label text per customer: bare codes, padded and doubled quotes, a section that
# ends on an entry and one that ends on a line of its own, comments between. Ports P0 to P24
# are where the arrivals land, and lie in the cities of the measurements.
_LABEL_TEXT = r"""concat(
  '/* codes of ', c_name, ' */\r\nproc format;\r\n  value i94cntyl\r\n   ',
  c_custkey, ' =  ''', c_name, ' (', c_mktsegment, ')'' ;\r\n\r\n/* 1 = ''none'' */\r\n',
  '  value $i94prtl\r\n   ''N', c_nationkey, ' ''\t=\t''PORT ', c_custkey, ', XX     ''   \r\n',
  '   ''C', c_custkey, '''\t=\t''INT''''L ', c_mktsegment, '''\r\n',
  '   ''P', pmod(c_custkey, 25), '''\t=\t''CITY ', pmod(c_custkey, 25), ', XX''\r\n;\r\n',
  'value i94model\r\n\t1 = ''Air'' ;\r\nvalue i94addrl\r\n\t''S', c_custkey, '''=''', c_mktsegment, ''' '
)"""


def label_texts(
    spark: SparkSession, sf_dir: str, customers: DataFrame | None = None, file: str = "cast(c_custkey as string)"
) -> DataFrame:
    """(file, text): a small label text per customer, the last section unclosed."""
    source = table(spark, sf_dir, "customer") if customers is None else customers
    return source.select(F.expr(file).alias("file"), F.expr(_LABEL_TEXT).alias("text"))


def raw_frames(spark: SparkSession, sf_dir: str) -> RawFrames:
    return RawFrames(
        raw_arrivals(spark, sf_dir),
        raw_temperature(spark, sf_dir),
        raw_demographics(spark, sf_dir),
        label_texts(spark, sf_dir),
    )


# Warehouse shapes, for the questions asked of finished tables.


def renamed(spark: SparkSession, sf_dir: str, name: str, names: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, name).select(
        *(named(old).alias(new) for old, new in names.items())
    )


def airline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed(
        spark, sf_dir, "lineitem", {"l_orderkey": "cic_id", "l_returnflag": "visa_type"}
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed(spark, sf_dir, "orders", {"o_orderkey": "cic_id", "o_orderstatus": "visa"})


def city_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed(spark, sf_dir, "nation", {"n_nationkey": "code", "n_name": "city"})


def customer_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as arrivals at the port of their nation."""
    return renamed(
        spark,
        sf_dir,
        "customer",
        {
            "c_custkey": "cic_id",
            "c_name": "name",
            "c_nationkey": "city_code",
            "c_mktsegment": "country",
        },
    )


def supplier_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as measurements in the city of their nation."""
    names = city_code(spark, sf_dir).withColumnsRenamed({"code": "s_nationkey"})
    return (
        table(spark, sf_dir, "supplier")
        .join(names, "s_nationkey")
        .select("s_suppkey", F.col("s_acctbal").alias("avg_temp"), "city")
    )


def temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed(
        spark,
        sf_dir,
        "events",
        {"event_id": "event_id", "user_id": "city", "value": "avg_temp", "ts": "dt"},
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed(
        spark,
        sf_dir,
        "lineitem",
        {
            "l_partkey": "city",
            "l_suppkey": "foreign_born",
            "l_quantity": "male_population",
            "l_tax": "female_population",
        },
    )
