"""Every operator as a query on the given tables, with the SQL it must agree with.

``@query(sql)`` registers a function under its name. A query without SQL has no
repeatable value and is checked by tests only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starquay.functions import columns as C
from starquay.operators import cleaning, keys, labels
from starquay.plans import analytics, load, quality, tables
from starquay.schemas import RAW_DEMOGRAPHICS, RAW_TEMPERATURE, TABLES, columns
from starquay.sources import readers, sinks, versions
from starquay.staging import new_path
from workload import standins
from workload.standins import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = " ".join(sql.split())
        return function

    return register


# --------------------------------------------------------------------------
# Finished tables in SQL, over the same stand-ins as in workload.standins.
# --------------------------------------------------------------------------
_MODE = "CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS INTEGER)"
_VISA = "CAST(CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 1 ELSE 3 END AS INTEGER)"
_STATE = "CASE WHEN o_orderpriority <> '5-LOW' THEN left(o_orderpriority, 1) END"

FACT_SQL = f"""
SELECT o_orderkey AS cic_id, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month,
  'P' || CAST(o_custkey % 25 AS VARCHAR) AS city_code,
  CAST(o_orderdate AS DATE) AS arrive_date,
  CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) + 10 END AS departure_date,
  {_MODE} AS mode, {_VISA} AS visa,
  row_number() OVER (ORDER BY o_orderkey) AS immigration_id,
  'United States' AS country, {_STATE} AS state_code
FROM orders"""
PERSONAL_SQL = """
SELECT o_orderkey AS cic_id, CAST(o_custkey AS INTEGER) AS citizen_country,
  CAST(o_custkey % 25 AS INTEGER) AS residence_country,
  CAST(1900 + o_custkey % 100 AS INTEGER) AS birth_year,
  CASE o_orderstatus WHEN 'O' THEN 'F' WHEN 'F' THEN 'M' END AS gender,
  row_number() OVER (ORDER BY o_orderkey) AS immi_personal_id
FROM orders"""
AIRLINE_SQL = """
SELECT o_orderkey AS cic_id, o_orderpriority AS airline,
  o_orderkey * 1000003 + 5000000000 AS admin_num,
  'F' || CAST(o_custkey AS VARCHAR) AS flight_number, 'B' || o_orderstatus AS visa_type,
  row_number() OVER (ORDER BY o_orderkey) AS immi_airline_id
FROM orders"""
# A row of NULLs stands after each order of high priority in the raw arrivals. It is
# dropped there, so none of the tables above has one.
TEMPERATURE_SQL = """
SELECT dt, CAST(value AS FLOAT) AS avg_temp, CAST(event_id AS FLOAT) AS avg_temp_uncertainty,
  'CITY ' || CAST(user_id AS VARCHAR) AS city, 'UNITED STATES' AS country,
  CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month
FROM (SELECT CAST(ts AS DATE) AS dt, user_id, value, event_id,
    row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
      ORDER BY value, CAST(event_id AS VARCHAR)) AS rn
  FROM events WHERE event_type = 'purchase' AND value <= 95) t
WHERE rn = 1"""
_CLEAN_DEMOGRAPHICS = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_linestatus, l_returnflag
    ORDER BY CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR),
      CAST(l_linenumber AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_tax AS VARCHAR)) AS rn
  FROM lineitem WHERE l_discount > 0) d
WHERE rn = 1"""
POPULATION_SQL = f"""
SELECT *, row_number() OVER (ORDER BY city, state, race) AS demog_pop_id FROM (
  SELECT DISTINCT 'Part ' || CAST(l_partkey AS VARCHAR) AS city, 'state ' || l_linestatus AS state,
    CAST(l_quantity AS INTEGER) AS male_population,
    CAST(trunc(l_extendedprice) AS INTEGER) AS female_population,
    l_linenumber AS num_veterans, CAST(l_suppkey AS INTEGER) AS foreign_born,
    l_returnflag AS race
  FROM ({_CLEAN_DEMOGRAPHICS}) c) p"""
STATISTICS_SQL = f"""
SELECT city, state, CAST(CAST(age AS DOUBLE) AS INTEGER) AS median_age,
  CAST(size AS FLOAT) AS avg_household_size,
  row_number() OVER (ORDER BY city, state, CAST(CAST(age AS DOUBLE) AS INTEGER),
    CAST(size AS FLOAT)) AS demog_stat_id
FROM (SELECT DISTINCT 'PART ' || CAST(l_partkey AS VARCHAR) AS city,
    'STATE ' || upper(l_linestatus) AS state, CAST(l_quantity AS VARCHAR) AS age,
    CAST(l_tax AS VARCHAR) AS size
  FROM ({_CLEAN_DEMOGRAPHICS}) c) s"""
COUNTRY_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS code, c_name || ' (' || c_mktsegment || ')' AS country
FROM customer"""
CITY_SQL = """
SELECT 'N' || CAST(c_nationkey AS VARCHAR) AS code, 'PORT ' || CAST(c_custkey AS VARCHAR) AS city
FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey
    ORDER BY CAST(c_custkey AS VARCHAR) DESC) AS rn FROM customer) t
WHERE rn = 1
UNION ALL
SELECT 'C' || CAST(c_custkey AS VARCHAR), 'INT''L ' || c_mktsegment FROM customer
UNION ALL
SELECT DISTINCT 'P' || CAST(c_custkey % 25 AS VARCHAR), 'CITY ' || CAST(c_custkey % 25 AS VARCHAR) FROM customer"""
STATE_SQL = """
SELECT 'S' || CAST(c_custkey AS VARCHAR) AS code, c_mktsegment AS state FROM customer"""

TABLE_SQL = {
    "fact_immigration": FACT_SQL,
    "dim_immigration_personal": PERSONAL_SQL,
    "dim_immigration_airline": AIRLINE_SQL,
    "dim_temperature": TEMPERATURE_SQL,
    "dim_demog_population": POPULATION_SQL,
    "dim_demog_statistics": STATISTICS_SQL,
    "country_code": COUNTRY_SQL,
    "city_code": CITY_SQL,
    "state_code": STATE_SQL,
}


# --------------------------------------------------------------------------
# Sources
# --------------------------------------------------------------------------
_ARRIVAL_COPIES = """
SELECT CAST(o_orderkey AS DOUBLE) AS cicid, 'P' || CAST(o_custkey % 25 AS VARCHAR) AS i94port,
  o_orderpriority AS airline FROM orders
UNION ALL
SELECT CAST(o_orderkey AS DOUBLE), 'P' || CAST(o_custkey % 25 AS VARCHAR), o_orderpriority
FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL
SELECT NULL, NULL, NULL FROM orders WHERE o_orderpriority = '2-HIGH'"""


@query(_ARRIVAL_COPIES)
def r1_staged_arrivals(spark, sf_dir):
    path = new_path(spark, "r1")
    standins.raw_arrivals(spark, sf_dir).write.parquet(f"{path}/part-1")
    return readers.read_arrivals(spark, f"{path}/*").select("cicid", "i94port", "airline")


@query(_ARRIVAL_COPIES)
def r1_csv_arrivals(spark, sf_dir):
    path = new_path(spark, "r1")
    standins.raw_arrivals(spark, sf_dir).write.csv(f"{path}/part-1", header=True)
    found = readers.read_arrivals(spark, f"{path}/*", format="csv")
    return found.select("cicid", "i94port", "airline")


@query(_ARRIVAL_COPIES)
def r1_fallback_arrivals(spark, sf_dir):
    path = new_path(spark, "r1")
    standins.raw_arrivals(spark, sf_dir).write.parquet(f"{path}/kept")
    found = readers.read_arrivals(
        spark, f"{path}/absent/*.csv", format="csv", fallback=f"{path}/kept"
    )
    return found.select("cicid", "i94port", "airline")


@query(
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt,
    CASE WHEN value <= 95 THEN CAST(value AS VARCHAR) END AS average,
    'city ' || CAST(user_id AS VARCHAR) AS city FROM events"""
)
def r2_text_csv(spark, sf_dir):
    path = new_path(spark, "r2")
    standins.raw_temperature(spark, sf_dir).write.csv(path, header=True)
    found = readers.read_csv(spark, path, RAW_TEMPERATURE)
    return found.select("dt", F.col("AverageTemperature").alias("average"), F.col("City").alias("city"))


@query(
    """SELECT 'Part ' || CAST(l_partkey AS VARCHAR) AS city,
    CAST(l_suppkey AS VARCHAR) AS foreign_born,
    CASE WHEN l_discount > 0 THEN CAST(l_linenumber AS VARCHAR) END AS num_veterans
    FROM lineitem"""
)
def r3_semicolon_csv(spark, sf_dir):
    path = new_path(spark, "r3")
    standins.raw_demographics(spark, sf_dir).write.csv(path, header=True, sep=";")
    found = readers.read_csv(spark, path, RAW_DEMOGRAPHICS, ";")
    return found.select(
        F.col("City").alias("city"),
        F.col("Foreign-born").alias("foreign_born"),
        F.col("Number of Veterans").alias("num_veterans"),
    )


@query("SELECT CAST(event_id AS INTEGER) AS event_id, event_type, value FROM events")
def r4_inferred_csv(spark, sf_dir):
    path = new_path(spark, "r4")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    events.write.csv(path, header=True)
    return readers.read_csv_inferred(spark, path)


@query(
    r"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, parts[i] AS line
    FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i
      FROM (SELECT doc_id, string_split_regex(text, '\r?\n') AS parts FROM documents) a) b"""
)
def r5_text_lines(spark, sf_dir):
    return readers.text_lines(table(spark, sf_dir, "documents"), "doc_id")


@query(COUNTRY_SQL)
def r6_code_pairs(spark, sf_dir):
    """Pairs of code and label become a table without passing through the driver."""
    entries = labels.label_entries(standins.label_texts(spark, sf_dir))
    return labels.country_codes(entries)


@query(PERSONAL_SQL)
def r7_stored_table(spark, sf_dir):
    root = new_path(spark, "r7")
    load.full_load(load.RawFrames(arrivals=standins.raw_arrivals(spark, sf_dir)), root)
    return readers.read_table(spark, root, "dim_immigration_personal")


@query(
    f"""SELECT 'country_code' AS table_name, count(*) AS records FROM ({COUNTRY_SQL}) a
    UNION ALL SELECT 'city_code', count(*) FROM ({CITY_SQL}) b
    UNION ALL SELECT 'state_code', count(*) FROM ({STATE_SQL}) c
    UNION ALL SELECT 'dim_temperature', count(*) FROM ({TEMPERATURE_SQL}) d"""
)
def r8_stored_tables(spark, sf_dir):
    """Only the tables that were loaded are found."""
    root = new_path(spark, "r8")
    raw = load.RawFrames(
        temperature=standins.raw_temperature(spark, sf_dir),
        labels=standins.label_texts(spark, sf_dir),
    )
    load.full_load(raw, root)
    return quality.row_counts(readers.stored_tables(spark, root))


# --------------------------------------------------------------------------
# Sinks and names
# --------------------------------------------------------------------------
@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def w1_overwritten_table(spark, sf_dir):
    path = new_path(spark, "w1")
    sinks.write_table(table(spark, sf_dir, "supplier"), path)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    sinks.write_table(customers, path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def w2_partitioned_round_trip(spark, sf_dir):
    path = new_path(spark, "w2")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    sinks.write_table(orders, path, partition_by="o_orderpriority")
    return spark.read.schema(orders.schema).parquet(path)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1
    ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders"""
)
def w2_partition_reload(spark, sf_dir):
    """One partition is loaded again; the others stay."""
    path = new_path(spark, "w2")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    sinks.write_table(orders, path, partition_by="o_orderpriority")
    again = orders.where(F.col("o_orderpriority") == "1-URGENT").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    sinks.write_table(
        again, path, partition_by="o_orderpriority", only_given_partitions=True
    )
    return spark.read.schema(orders.schema).parquet(path)


@query(
    "SELECT visa, count(*) AS arrivals FROM (SELECT o_orderstatus AS visa FROM orders) t GROUP BY visa"
)
def w3_named_view(spark, sf_dir):
    sinks.publish({"fact_immigration": standins.fact(spark, sf_dir)})
    return spark.sql("select visa, count(*) as arrivals from fact_immigration group by visa")


@query("SELECT o_orderkey, o_custkey FROM orders")
def w4_append_new_only(spark, sf_dir):
    """Rows that are stored already are not added again."""
    incoming = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    stored = incoming.where(F.col("o_orderstatus") == "F")
    added = sinks.new_rows(stored, incoming, ["o_orderkey"])
    return stored.unionByName(added).select("o_orderkey", "o_custkey")


@query(
    FACT_SQL.replace(
        "ORDER BY o_orderkey",
        "ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderkey",
    )
)
def w4_refreshed_fact(spark, sf_dir):
    """A first load of a part, then a refresh with everything: keys go on."""
    root = new_path(spark, "w4")
    first = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    load.full_load(
        load.RawFrames(arrivals=standins.raw_arrivals(spark, sf_dir, first)), root
    )
    load.refresh(
        spark, load.RawFrames(arrivals=standins.raw_arrivals(spark, sf_dir)), root
    )
    return readers.read_table(spark, root, "fact_immigration")


_KNOWN_IDS_AGAIN = """
SELECT o_orderkey, o_orderstatus, o_orderdate, o_custkey + 1 AS o_custkey, o_orderpriority
FROM orders WHERE o_orderpriority = '1-URGENT'"""


@query(
    f"""SELECT * EXCLUDE (immigration_id) FROM ({FACT_SQL}) a
    UNION SELECT * EXCLUDE (immigration_id) FROM (
      {FACT_SQL.replace("FROM orders", f"FROM ({_KNOWN_IDS_AGAIN}) k")}) b"""
)
def w4_refresh_equals_full_load(spark, sf_dir):
    """A part is loaded; the rest, and known ids with other values, arrive later."""
    root = new_path(spark, "w4")
    orders = table(spark, sf_dir, "orders")
    again = orders.where("o_orderpriority = '1-URGENT'").withColumn("o_custkey", F.col("o_custkey") + 1)
    first = standins.raw_arrivals(spark, sf_dir, orders.where("o_orderstatus = 'F'"))
    later = standins.raw_arrivals(spark, sf_dir, orders.unionByName(again))
    load.full_load(load.RawFrames(arrivals=first), root)
    load.refresh(spark, load.RawFrames(arrivals=later), root)
    return readers.read_table(spark, root, "fact_immigration").drop("immigration_id")


# The raw rows of two batches: the given ones, and the same keys with other values.
_LATER_TOWNS = """(SELECT * FROM lineitem
  UNION ALL SELECT * REPLACE (l_suppkey + 1 AS l_suppkey) FROM lineitem) batches"""
_LATER_MONTHS = """(SELECT * FROM events UNION ALL
  SELECT * REPLACE (CASE WHEN user_id % 2 = 0 THEN value - 1 ELSE value + 1 END AS value) FROM events) batches"""
_LATER_LABELS = """(SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(c_custkey AS VARCHAR) AS file FROM customer
  UNION ALL SELECT c_custkey, c_name, c_nationkey, 'NEW ' || c_mktsegment, 'z' || CAST(c_custkey AS VARCHAR)
  FROM customer WHERE c_acctbal > 0) batches"""


def _two_batches_of_towns(spark, sf_dir) -> str:
    """The next year brings the same towns with other figures."""
    root = new_path(spark, "w4")
    raw = standins.raw_demographics(spark, sf_dir)
    later = raw.withColumn("Foreign-born", (F.col("Foreign-born").cast("int") + 1).cast("string"))
    load.full_load(load.RawFrames(demographics=raw), root)
    load.refresh(spark, load.RawFrames(demographics=later), root)
    return root


@query(
    f"SELECT * EXCLUDE (demog_pop_id) FROM ({POPULATION_SQL.replace('FROM lineitem', f'FROM {_LATER_TOWNS}')}) t"
)
def w4_refresh_with_new_figures(spark, sf_dir):
    """One row per town and race is left, the one that a load of both years would pick."""
    root = _two_batches_of_towns(spark, sf_dir)
    return readers.read_table(spark, root, "dim_demog_population").drop("demog_pop_id")


@query(
    f"SELECT * EXCLUDE (demog_stat_id) FROM ({STATISTICS_SQL.replace('FROM lineitem', f'FROM {_LATER_TOWNS}')}) t"
)
def w4_demographics_equal_full_load(spark, sf_dir):
    root = _two_batches_of_towns(spark, sf_dir)
    return readers.read_table(spark, root, "dim_demog_statistics").drop("demog_stat_id")


@query(TEMPERATURE_SQL.replace("FROM events", f"FROM {_LATER_MONTHS}"))
def w4_merge_equals_full_load(spark, sf_dir):
    """A later batch measures known cities and days again, colder or warmer."""
    root = new_path(spark, "w4")
    events = table(spark, sf_dir, "events")
    again = F.expr("case when user_id % 2 = 0 then value - 1 else value + 1 end")
    later = standins.raw_temperature(spark, sf_dir, events.withColumn("value", again))
    load.full_load(load.RawFrames(temperature=standins.raw_temperature(spark, sf_dir)), root)
    load.refresh(spark, load.RawFrames(temperature=later), root)
    return readers.read_table(spark, root, "dim_temperature")


@query(
    f"""SELECT list, code, label FROM (SELECT *, row_number() OVER (PARTITION BY list, code ORDER BY file DESC) AS rn FROM (
      SELECT 'country_code' AS list, CAST(c_custkey AS VARCHAR) AS code, c_name || ' (' || c_mktsegment || ')' AS label,
        file FROM {_LATER_LABELS}
      UNION ALL SELECT 'city_code', 'N' || CAST(c_nationkey AS VARCHAR), 'PORT ' || CAST(c_custkey AS VARCHAR), file
      FROM {_LATER_LABELS}
      UNION ALL SELECT 'city_code', 'C' || CAST(c_custkey AS VARCHAR), 'INT''L ' || c_mktsegment, file FROM {_LATER_LABELS}
      UNION ALL SELECT 'city_code', 'P' || CAST(c_custkey % 25 AS VARCHAR), 'CITY ' || CAST(c_custkey % 25 AS VARCHAR), file
      FROM {_LATER_LABELS}
      UNION ALL SELECT 'state_code', 'S' || CAST(c_custkey AS VARCHAR), c_mktsegment, file FROM {_LATER_LABELS}) e) t
    WHERE rn = 1"""
)
def w4_merged_codes_equal_full_load(spark, sf_dir):
    """Later files give known codes other labels."""
    root = new_path(spark, "w4")
    some = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    some = some.withColumn("c_mktsegment", F.concat(F.lit("NEW "), "c_mktsegment"))
    later = standins.label_texts(spark, sf_dir, some, "concat('z', c_custkey)")
    load.full_load(load.RawFrames(labels=standins.label_texts(spark, sf_dir)), root)
    load.refresh(spark, load.RawFrames(labels=later), root)
    names = ("country_code", "city_code", "state_code")
    lists = [readers.read_table(spark, root, name).toDF("code", "label").withColumn("list", F.lit(name)) for name in names]
    return lists[0].unionByName(lists[1]).unionByName(lists[2])


@query(
    """SELECT 1 AS batch, TRUE AS new_files, count(*) AS rows_stored FROM orders
    UNION ALL SELECT 2, FALSE, count(*) FROM orders"""
)
def w4_refresh_reads_only_new_files(spark, sf_dir):
    """Raw files by status; the second time the ledger knows them all, so none is read."""
    folder, root = new_path(spark, "raw"), new_path(spark, "w4")
    raw = standins.raw_arrivals(spark, sf_dir).where("cicid is not null")
    raw.write.parquet(folder)
    found = []
    for batch in (1, 2):
        frames, files = load.read_unseen(spark, root, {"arrivals": folder})
        if files is not None:
            load.refresh(spark, frames, root, files=files)
        stored = readers.read_table(spark, root, "fact_immigration").count()
        found.append((batch, files is not None, stored))
    return spark.createDataFrame(found, "batch int, new_files boolean, rows_stored bigint")


@query(
    "SELECT event_id, event_type, value FROM events WHERE event_type = 'purchase' ORDER BY event_id LIMIT 5000"
)
def w5_csv_sample(spark, sf_dir):
    path = new_path(spark, "w5")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    purchases = events.where(F.col("event_type") == "purchase")
    sinks.write_csv_sample(purchases, path, 5000, ["event_id"])
    return readers.read_csv(spark, path, events.schema)


# --------------------------------------------------------------------------
# Projections, renames, casts
# --------------------------------------------------------------------------
@query(
    """SELECT o_orderkey AS cic_id, o_custkey AS city_code, o_orderpriority AS state_code,
    'United States' AS country FROM orders"""
)
def p1_project_rename(spark, sf_dir):
    names = {"o_orderkey": "cic_id", "o_custkey": "city_code", "o_orderpriority": "state_code"}
    return (
        table(spark, sf_dir, "orders")
        .select(*names)
        .withColumnsRenamed(names)
        .withColumn("country", F.lit("United States"))
    )


@query(
    "SELECT c_custkey AS id, c_name AS label, c_nationkey, c_acctbal, c_mktsegment FROM customer"
)
def p2_rename_by_position(spark, sf_dir):
    return C.rename_by_position(table(spark, sf_dir, "customer"), ["id", "label"])


@query("SELECT event_id, ts, user_id, event_type FROM events")
def p3_drop_columns(spark, sf_dir):
    return table(spark, sf_dir, "events").drop("value", "props", "absent")


@query("SELECT p_partkey, p_brand, 'United States' AS country FROM part")
def p4_constant_column(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return parts.withColumn("country", F.lit("United States"))


@query(
    """SELECT CAST(event_id AS INTEGER) AS event_id, CAST(ts AS DATE) AS dt,
    CAST(user_id AS VARCHAR) AS city, CAST(trunc(value) AS INTEGER) AS avg_temp FROM events"""
)
def p5_cast_schema(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnsRenamed(
        {"ts": "dt", "user_id": "city", "value": "avg_temp"}
    )
    return C.cast_to_schema(events, columns("event_id int, dt date, city string, avg_temp int"))


@query("SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS price FROM lineitem")
def p6_to_integer(spark, sf_dir):
    price = C.to_integer(F.col("l_extendedprice").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", price.alias("price")
    )


@query(
    """SELECT l_orderkey, l_linenumber, round(l_quantity + l_tax, 4) AS population FROM lineitem"""
)
def p7_computed_column(spark, sf_dir):
    total = F.round(F.col("l_quantity") + F.col("l_tax"), 4)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", total.alias("population")
    )


@query(
    """SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""
)
def p8_star_and_qualified(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer").alias("c"), table(spark, sf_dir, "nation").alias("n")
    return c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey")).select("c.*", "n.n_name")


# --------------------------------------------------------------------------
# Filters, missing values, duplicates
# --------------------------------------------------------------------------
@query("SELECT event_id, value FROM events WHERE event_type = 'purchase'")
def f1_equality_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.where(F.col("event_type") == "purchase").select("event_id", "value")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def f2_threshold_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_totalprice") > 250000).select("o_orderkey", "o_totalprice")


def _with_gaps(spark, sf_dir):
    """Events where type and value are sometimes NULL."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("a"),
        F.when(F.col("value") <= 50, F.col("value")).alias("b"),
        "user_id",
    )


@query(
    """SELECT a, b FROM (SELECT nullif(event_type, 'error') AS a,
      CASE WHEN value > 50 THEN NULL ELSE value END AS b FROM events) t
    WHERE NOT (a IS NULL AND b IS NULL)"""
)
def n1_drop_all_null(spark, sf_dir):
    return _with_gaps(spark, sf_dir).select("a", "b").na.drop("all")


@query(
    """SELECT event_id, a, b FROM (SELECT event_id, nullif(event_type, 'error') AS a,
      CASE WHEN value > 50 THEN NULL ELSE value END AS b FROM events) t
    WHERE a IS NOT NULL AND b IS NOT NULL"""
)
def n2_drop_any_null(spark, sf_dir):
    gaps = _with_gaps(spark, sf_dir).select("event_id", "a", "b")
    return gaps.na.drop("any", subset=["a", "b"])


def _labelled_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )


@query(
    """SELECT column_name FROM (
      SELECT 'quality' AS column_name, avg(CASE WHEN quality IS NULL THEN 1.0 ELSE 0.0 END) AS share
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
      UNION ALL SELECT 'text', avg(CASE WHEN text IS NULL THEN 1.0 ELSE 0.0 END) FROM documents) t
    WHERE share > 0.5"""
)
def n3_columns_over_threshold(spark, sf_dir):
    return cleaning.sparse_columns(
        _labelled_documents(spark, sf_dir).select("quality", "text"), 0.5
    )


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def n3_drop_sparse_columns(spark, sf_dir):
    documents = _labelled_documents(spark, sf_dir).drop("text")
    return cleaning.drop_sparse_columns(documents, 0.5)


@query(
    """SELECT column_name, missing_count, round(missing_count / total * 100, 6) AS missing_percentage
    FROM (SELECT 'event_type' AS column_name,
        CAST(sum(CASE WHEN nullif(event_type, 'error') IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_count,
        count(*) AS total FROM events
      UNION ALL SELECT 'value', CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS BIGINT), count(*) FROM events
      UNION ALL SELECT 'user_id', CAST(sum(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS BIGINT), count(*) FROM events) t
    WHERE missing_count > 0"""
)
def n4_missing_profile(spark, sf_dir):
    gaps = _with_gaps(spark, sf_dir).withColumnsRenamed({"a": "event_type", "b": "value"})
    profile = cleaning.missing_profile(gaps.select("event_type", "value", "user_id"))
    return profile.withColumn("missing_percentage", F.round("missing_percentage", 6))


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def d1_distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus").distinct()


@query(
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER
      (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) t WHERE rn = 1"""
)
def d2_distinct_on_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "ts", "event_id", "value"
    )
    return cleaning.first_per_key(events, ["user_id", "event_type"]).drop("ts")


@query("SELECT DISTINCT l_partkey, round(l_quantity + l_tax, 4) AS population FROM lineitem")
def d3_distinct_expressions(spark, sf_dir):
    total = F.round(F.col("l_quantity") + F.col("l_tax"), 4)
    return (
        table(spark, sf_dir, "lineitem").select("l_partkey", total.alias("population")).distinct()
    )


# --------------------------------------------------------------------------
# Joins
# --------------------------------------------------------------------------
@query(
    """SELECT l_orderkey AS cic_id, l_returnflag AS visa_type, o_orderstatus AS visa
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def j1_dimension_to_fact(spark, sf_dir):
    return standins.airline(spark, sf_dir).join(standins.fact(spark, sf_dir), "cic_id")


@query(
    "SELECT c_custkey AS cic_id, n_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey"
)
def j2_fact_to_code_list(spark, sf_dir):
    codes = standins.city_code(spark, sf_dir).withColumnsRenamed({"code": "city_code"})
    arrivals = standins.customer_arrivals(spark, sf_dir)
    return arrivals.join(codes, "city_code").select("cic_id", "city")


@query(
    """SELECT s_suppkey, n_nationkey AS code, s_acctbal AS avg_temp FROM supplier
    JOIN nation ON s_nationkey = n_nationkey"""
)
def j3_name_lookup(spark, sf_dir):
    measured = standins.supplier_temperatures(spark, sf_dir)
    found = measured.join(standins.city_code(spark, sf_dir), "city")
    return found.select("s_suppkey", "code", "avg_temp")


@query(
    """SELECT n_regionkey, count(*) AS pairs FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN customer ON n_nationkey = c_nationkey GROUP BY n_regionkey"""
)
def j4_star_totals(spark, sf_dir):
    """Totals over the three-table star, from those of each port."""
    ports = analytics.star_totals(
        standins.supplier_temperatures(spark, sf_dir),
        standins.city_code(spark, sf_dir),
        standins.customer_arrivals(spark, sf_dir),
    )
    regions = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("city_code"), "n_regionkey")
    return ports.join(regions, "city_code").groupBy("n_regionkey").agg(F.sum("pairs").alias("pairs"))


@query(
    """SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_custkey = 42"""
)
def j5_filter_on_join_key(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.where(F.col("o_custkey") == 42).select("o_orderkey", "c_name")


# --------------------------------------------------------------------------
# Aggregations, order, reshaping
# --------------------------------------------------------------------------
@query(
    """SELECT user_id, count(nullif(event_type, 'error')) AS events FROM events GROUP BY user_id"""
)
def a1_count_per_group(spark, sf_dir):
    return _with_gaps(spark, sf_dir).groupBy("user_id").agg(F.count("a").alias("events"))


@query("SELECT l_returnflag, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY l_returnflag")
def a2_mean_per_group(spark, sf_dir):
    mean = F.round(F.avg("l_quantity"), 6).alias("mean")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(mean)


@query(
    """SELECT count(*) - count(nullif(event_type, 'error')) AS a,
    count(*) - count(CASE WHEN value <= 50 THEN 1 END) AS b FROM events"""
)
def a3_null_flag_sums(spark, sf_dir):
    gaps = _with_gaps(spark, sf_dir)
    return gaps.agg(*(F.sum(C.missing_flag(F.col(c))).alias(c) for c in ("a", "b")))


@query("SELECT count(*) AS n FROM lineitem")
def a4_row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"
)
def o1_top_ten(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("SELECT event_id, value FROM events ORDER BY value, event_id")
def o2_full_sort(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "value").orderBy("value", "event_id")


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 5")
def o3_first_rows(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name").orderBy("p_partkey").limit(5)


@query(
    """SELECT column_name, missing_count FROM (
      SELECT 'quality' AS column_name, (SELECT count(*) FROM documents) - (SELECT count(quality)
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id) AS missing_count
      UNION ALL SELECT 'lang', count(*) - count(lang) FROM documents) t"""
)
def u1_wide_to_long(spark, sf_dir):
    counts = _labelled_documents(spark, sf_dir).agg(
        *(F.count_if(F.col(c).isNull()).alias(c) for c in ("quality", "lang"))
    )
    return counts.unpivot([], ["quality", "lang"], "column_name", "missing_count")


# --------------------------------------------------------------------------
# Scalar functions
# --------------------------------------------------------------------------
@query(
    "SELECT event_id, DATE '1960-01-01' + CAST(floor(value) AS INTEGER) AS arrive_date FROM events"
)
def c1_day_number_to_date(spark, sf_dir):
    date = C.day_number_to_date(F.col("value")).alias("arrive_date")
    return table(spark, sf_dir, "events").select("event_id", date)


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month, upper(o_orderpriority) AS priority FROM orders"""
)
def c2_year_month_upper(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.upper("o_orderpriority").alias("priority"),
    )


@query(
    """SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS missing
    FROM events"""
)
def c5_null_flag(spark, sf_dir):
    gaps = _with_gaps(spark, sf_dir)
    return gaps.select("event_id", C.missing_flag(F.col("a")).alias("missing"))


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <> 0
    THEN round(l_discount / l_tax * 100, 6) END AS share FROM lineitem"""
)
def c6_percent_of_total(spark, sf_dir):
    share = F.round(C.percent_of(F.col("l_discount"), F.col("l_tax")), 6)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", share.alias("share")
    )


@query(
    """SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS small, CAST(o_totalprice AS FLOAT) AS price,
    CAST(o_custkey AS VARCHAR) AS label, CAST(o_orderdate AS DATE) AS day FROM orders"""
)
def c9_casts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").try_cast("int").alias("small"),
        F.col("o_totalprice").cast("float").alias("price"),
        F.col("o_custkey").cast("string").alias("label"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


@query(
    """SELECT n_nationkey, trim(split_part(n_name || ' , ' || n_regionkey, ',', 1)) AS city
    FROM nation"""
)
def c10_text_before_comma(spark, sf_dir):
    label = F.concat_ws(" , ", "n_name", "n_regionkey")
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", C.text_before_comma(label).alias("city")
    )


@query("SELECT doc_id, trim(split_part(text, ',', 1), ' ') AS head FROM documents")
def c10_document_heads(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", C.text_before_comma(F.col("text")).alias("head")
    )


# --------------------------------------------------------------------------
# Keys
# --------------------------------------------------------------------------
@query("SELECT count(*) AS n, count(*) AS ids FROM orders")
def k1_unique_key(spark, sf_dir):
    orders = keys.unique_key(table(spark, sf_dir, "orders"), "id")
    return orders.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"))


@query(
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS immigration_id
    FROM orders"""
)
def k2_dense_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    keyed = keys.dense_key(orders, "immigration_id", ["o_totalprice", "o_orderkey"])
    return keyed.select("o_orderkey", "immigration_id")


@query(
    """SELECT event_id, row_number() OVER (ORDER BY event_type, event_id) AS id FROM events"""
)
def k2_dense_key_on_text(spark, sf_dir):
    """A few values lead the order, each with a large share of the rows."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return keys.dense_key(events, "id", ["event_type"]).select("event_id", "id")


# --------------------------------------------------------------------------
# Label lists
# --------------------------------------------------------------------------
@query(
    """SELECT 'r' || CAST(n_regionkey AS VARCHAR) AS section, CAST(n_nationkey AS VARCHAR) AS code,
    n_name AS label FROM nation"""
)
def l1_label_entries(spark, sf_dir):
    text = F.expr("concat('  value r', n_regionkey, '\\r\\n   ', n_nationkey, ' =  ''', n_name, ''' ;')")
    texts = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("file"), text.alias("text")
    )
    return labels.label_entries(texts).select("section", "code", "label")


_LABEL_SQL = f"""SELECT 'i94cntyl' AS section, code, country AS label FROM ({COUNTRY_SQL}) a
    UNION ALL SELECT 'i94prtl', 'N' || CAST(c_nationkey AS VARCHAR),
      'PORT ' || CAST(c_custkey AS VARCHAR) || ', XX' FROM customer
    UNION ALL SELECT 'i94prtl', 'C' || CAST(c_custkey AS VARCHAR), 'INT''L ' || c_mktsegment FROM customer
    UNION ALL SELECT 'i94prtl', 'P' || CAST(c_custkey % 25 AS VARCHAR),
      'CITY ' || CAST(c_custkey % 25 AS VARCHAR) || ', XX' FROM customer
    UNION ALL SELECT 'i94model', '1', 'Air' FROM customer
    UNION ALL SELECT 'i94addrl', code, state FROM ({STATE_SQL}) c"""


@query(_LABEL_SQL)
def l1_customer_label_texts(spark, sf_dir):
    entries = labels.label_entries(standins.label_texts(spark, sf_dir))
    return entries.select("section", "code", "label")


@query(_LABEL_SQL)
def l1_label_splits(spark, sf_dir):
    """All label texts in a few long files, which are parsed in parts."""
    path = new_path(spark, "labels")
    standins.label_texts(spark, sf_dir).select("text").write.text(path)
    entries = labels.label_entries_of_splits(readers.read_text_splits(spark, path))
    return entries.select("section", "code", "label")


@query(COUNTRY_SQL)
def l2_country_codes(spark, sf_dir):
    return labels.country_codes(labels.label_entries(standins.label_texts(spark, sf_dir)))


@query(CITY_SQL)
def l3_city_codes(spark, sf_dir):
    return labels.city_codes(labels.label_entries(standins.label_texts(spark, sf_dir)))


@query(STATE_SQL)
def l4_state_codes(spark, sf_dir):
    return labels.state_codes(labels.label_entries(standins.label_texts(spark, sf_dir)))


# --------------------------------------------------------------------------
# Tables
# --------------------------------------------------------------------------
@query(
    """SELECT CAST(o_orderkey AS DOUBLE) AS cicid, o_orderpriority AS airline FROM orders
    UNION ALL SELECT CAST(o_orderkey AS DOUBLE), o_orderpriority FROM orders
    WHERE o_orderpriority = '1-URGENT'"""
)
def t0_clean_arrivals(spark, sf_dir):
    clean = tables.clean_arrivals(standins.raw_arrivals(spark, sf_dir))
    return clean.select("cicid", "airline")


@query(FACT_SQL)
def t1_fact_table(spark, sf_dir):
    arrivals, _ = load.stage_arrivals(standins.raw_arrivals(spark, sf_dir))
    return tables.fact_immigration(arrivals)


@query(PERSONAL_SQL)
def t2_personal_table(spark, sf_dir):
    arrivals, _ = load.stage_arrivals(standins.raw_arrivals(spark, sf_dir))
    return tables.dim_immigration_personal(arrivals)


@query(AIRLINE_SQL)
def t3_airline_table(spark, sf_dir):
    arrivals, _ = load.stage_arrivals(standins.raw_arrivals(spark, sf_dir))
    return tables.dim_immigration_airline(arrivals)


@query(TEMPERATURE_SQL)
def t4_temperature_table(spark, sf_dir):
    return tables.dim_temperature(standins.raw_temperature(spark, sf_dir))


@query(POPULATION_SQL)
def t5_population_table(spark, sf_dir):
    clean = tables.clean_demographics(standins.raw_demographics(spark, sf_dir))
    return tables.dim_demog_population(clean)


@query(STATISTICS_SQL)
def t6_statistics_table(spark, sf_dir):
    clean = tables.clean_demographics(standins.raw_demographics(spark, sf_dir))
    return tables.dim_demog_statistics(clean)


@query(
    f"""SELECT 'country_code' AS list, code, country AS label FROM ({COUNTRY_SQL}) a
    UNION ALL SELECT 'city_code', code, city FROM ({CITY_SQL}) b
    UNION ALL SELECT 'state_code', code, state FROM ({STATE_SQL}) c"""
)
def t7_code_tables(spark, sf_dir):
    lists = tables.code_tables(standins.label_texts(spark, sf_dir))
    frames = [
        df.toDF("code", "label").select(F.lit(name).alias("list"), "code", "label")
        for name, df in lists.items()
    ]
    return frames[0].unionAll(frames[1]).unionAll(frames[2])


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS records FROM ({sql}) {name}"
        for name, sql in TABLE_SQL.items()
    )
)
def t8_whole_load(spark, sf_dir):
    """All nine tables written, checked and counted."""
    root = new_path(spark, "t8")
    load.full_load(standins.raw_frames(spark, sf_dir), root)
    return load.check(spark, root)


# --------------------------------------------------------------------------
# Quality
# --------------------------------------------------------------------------
_GIVEN = {
    "orders": columns(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    ),
    "customer": columns(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": columns("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
}


@query(
    """SELECT 'orders' AS table_name, FALSE AS ok, count(*) AS records FROM orders
    UNION ALL SELECT 'customer', TRUE, count(*) FROM customer
    UNION ALL SELECT 'supplier', TRUE, count(*) FROM supplier"""
)
def q1_schema_report(spark, sf_dir):
    """Expected against found columns; the expectation for orders lacks some."""
    found = {name: table(spark, sf_dir, name) for name in _GIVEN}
    report = quality.schema_report(spark, found, _GIVEN)
    return report.drop("detail").join(quality.row_counts(found), "table_name")


@query(
    """SELECT 'state_code' AS table_name, 'S' || CAST(n AS VARCHAR) AS part, ok, c AS records
    FROM (VALUES (1, TRUE), (2, FALSE), (3, FALSE)) AS v(n, ok), (SELECT count(*) AS c FROM customer) t"""
)
def q1_file_schemas(spark, sf_dir):
    """Three parts of a table: as it should be, with a number for a text, without a column."""
    root = new_path(spark, "q1")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("code"), F.col("c_mktsegment").alias("state")
    )
    parts = {"S1": rows, "S2": rows.withColumn("code", F.col("code").cast("int")), "S3": rows.drop("state")}
    paths = {name: sinks.write_segment(df, root, "state_code") for name, df in parts.items()}
    versions.publish(spark, root, versions.Version(), {"state_code": [p for held in paths.values() for p in held]})
    report = quality.file_schema_report(spark, root, ["state_code"])
    names = F.create_map(*(F.lit(x) for name, (path,) in paths.items() for x in (path.rsplit("=", 1)[1], name)))
    part = names[F.regexp_extract("file", r"segment=(\w+)", 1)]
    found = report.groupBy("table_name", part.alias("part")).agg(F.bool_and("ok").alias("ok"))
    sizes = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("part"), "records") for name, df in parts.items()
    ]
    return found.join(sizes[0].unionByName(sizes[1]).unionByName(sizes[2]), "part")


@query(
    "SELECT 'orders' AS table_name, count(*) AS records FROM orders UNION ALL SELECT 'events', count(*) FROM events"
)
def q2_table_counts(spark, sf_dir):
    found = {name: table(spark, sf_dir, name) for name in ("orders", "events")}
    return quality.require_rows(spark, found)


@query(
    """SELECT count(*) AS before_rows, count(nullif(event_type, 'error')) AS after_rows,
    count(*) - count(nullif(event_type, 'error')) AS difference FROM events"""
)
def q3_before_after(spark, sf_dir):
    return cleaning.rows_before_and_after(
        _with_gaps(spark, sf_dir), F.col("a").isNotNull()
    )


@query(
    """SELECT 'supplier' AS table_name, CAST(p AS INTEGER) AS position, n AS column_name, t AS type
    FROM (VALUES (1, 's_suppkey', 'bigint'), (2, 's_name', 'string'), (3, 's_nationkey', 'int'),
      (4, 's_acctbal', 'double')) AS v(p, n, t)"""
)
def q4_schema_listing(spark, sf_dir):
    return quality.schema_listing(spark, {"supplier": table(spark, sf_dir, "supplier")})


# --------------------------------------------------------------------------
# Questions
# --------------------------------------------------------------------------
@query(
    """SELECT DISTINCT l_partkey AS city, l_suppkey AS foreign_born,
    round(l_quantity + l_tax, 4) AS population FROM lineitem
    ORDER BY population DESC, city, foreign_born LIMIT 10"""
)
def g1_top_population(spark, sf_dir):
    top = analytics.largest_cities(standins.population(spark, sf_dir))
    return top.withColumn("population", F.round("population", 4))


@query(
    """SELECT l_returnflag AS visa_type, count(o_orderstatus) AS visa FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey GROUP BY l_returnflag
    ORDER BY visa DESC, visa_type LIMIT 10"""
)
def g2_visa_type_usage(spark, sf_dir):
    return analytics.visa_type_usage(
        standins.airline(spark, sf_dir), standins.fact(spark, sf_dir)
    )


@query("SELECT n_nationkey AS code, n_name AS city FROM nation ORDER BY code LIMIT 10")
def g3_code_list(spark, sf_dir):
    return analytics.city_code_list(standins.city_code(spark, sf_dir))


@query(
    """SELECT c_custkey AS cic_id, c_name AS name, c_nationkey AS city_code, c_mktsegment AS country,
    n_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey
    ORDER BY c_custkey LIMIT 10"""
)
def g4_fact_code_lookup(spark, sf_dir):
    return analytics.arrivals_with_city(
        standins.customer_arrivals(spark, sf_dir), standins.city_code(spark, sf_dir), ["cic_id"]
    )


@query(
    """SELECT event_id, user_id AS city, value AS avg_temp, ts AS dt FROM events
    ORDER BY value DESC, event_id LIMIT 10"""
)
def g5_warmest(spark, sf_dir):
    return analytics.warmest_records(standins.temperature(spark, sf_dir), ["event_id"])


@query(
    """SELECT s_suppkey, m.n_nationkey AS code, s_acctbal AS avg_temp, CAST(r_name AS VARCHAR) AS city
    FROM supplier JOIN nation n ON s_nationkey = n.n_nationkey
    JOIN region ON n.n_regionkey = r_regionkey JOIN nation m ON m.n_regionkey = r_regionkey"""
)
def g6_name_join_sorted(spark, sf_dir):
    """A name with many codes: each row comes once per code of its region."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    codes = nations.select(F.col("n_nationkey").alias("code"), F.col("r_name").alias("city"))
    measured = table(spark, sf_dir, "supplier").join(codes, F.col("s_nationkey") == F.col("code"))
    return analytics.port_temperatures(
        measured.select("s_suppkey", F.col("s_acctbal").alias("avg_temp"), "city"), codes
    )


@query("SELECT user_id AS city, round(avg(value), 6) AS average_temp FROM events GROUP BY user_id")
def g7_mean_by_city(spark, sf_dir):
    means = analytics.mean_temperatures(standins.temperature(spark, sf_dir))
    return means.withColumn("average_temp", F.round("average_temp", 6))


@query(
    """SELECT n_nationkey AS city_code, n_name AS city, measurements, arrivals,
      measurements * arrivals AS pairs, round(average_temp, 6) AS average_temp
    FROM nation
    JOIN (SELECT s_nationkey, count(*) AS measurements, avg(s_acctbal) AS average_temp
      FROM supplier GROUP BY s_nationkey) s ON s_nationkey = n_nationkey
    JOIN (SELECT c_nationkey, count(*) AS arrivals FROM customer GROUP BY c_nationkey) c
      ON c_nationkey = n_nationkey"""
)
def g8_three_way_star(spark, sf_dir):
    ports = analytics.star_totals(
        standins.supplier_temperatures(spark, sf_dir),
        standins.city_code(spark, sf_dir),
        standins.customer_arrivals(spark, sf_dir),
    )
    return ports.withColumn("average_temp", F.round("average_temp", 6))


@query(
    """SELECT s.s_acctbal AS avg_temp, n.n_name AS city, c.c_mktsegment AS country, count(*) AS arrivals
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN customer c ON n.n_nationkey = c.c_nationkey GROUP BY 1, 2, 3"""
)
def g8_temperature_at_arrival(spark, sf_dir):
    return analytics.temperature_at_arrival(
        standins.supplier_temperatures(spark, sf_dir),
        standins.city_code(spark, sf_dir),
        standins.customer_arrivals(spark, sf_dir),
    )


@query(
    """SELECT n_name AS city, c_mktsegment AS visa FROM nation JOIN customer
    ON n_nationkey = c_nationkey WHERE c_nationkey = 3"""
)
def g9_join_key_filter(spark, sf_dir):
    arrivals = standins.customer_arrivals(spark, sf_dir).withColumnsRenamed({"country": "visa"})
    return analytics.visa_at_port(arrivals, standins.city_code(spark, sf_dir), 3)


# --------------------------------------------------------------------------
# The same questions, asked of the stored warehouse
# --------------------------------------------------------------------------
_warehouses: dict[tuple[str, str], str] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Root of the warehouse loaded from these tables, once per application."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _warehouses:
        root = new_path(spark, "warehouse")
        load.full_load(standins.raw_frames(spark, sf_dir), root)
        _warehouses[at] = root
    return _warehouses[at]


def stored(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    root = warehouse(spark, sf_dir)
    return [readers.read_table(spark, root, name) for name in names]


def _of(name: str) -> str:
    return f"({TABLE_SQL[name]}) {name}"


@query(
    f"""SELECT city, foreign_born, population FROM (
      SELECT DISTINCT city, foreign_born, male_population + female_population AS population
      FROM {_of("dim_demog_population")}) t
    ORDER BY population DESC, city, foreign_born LIMIT 10"""
)
def wh_g1_largest_cities(spark, sf_dir):
    return analytics.largest_cities(*stored(spark, sf_dir, "dim_demog_population"))


@query(
    f"""SELECT visa_type, count(visa) AS visa FROM {_of("dim_immigration_airline")}
    JOIN {_of("fact_immigration")} USING (cic_id)
    GROUP BY visa_type ORDER BY visa DESC, visa_type LIMIT 10"""
)
def wh_g2_visa_types(spark, sf_dir):
    return analytics.visa_type_usage(*stored(spark, sf_dir, "dim_immigration_airline", "fact_immigration"))


@query(f"SELECT code, city FROM {_of('city_code')} ORDER BY code, city LIMIT 10")
def wh_g3_city_codes(spark, sf_dir):
    return analytics.city_code_list(*stored(spark, sf_dir, "city_code"))


@query(
    f"""SELECT fact_immigration.*, city_code.city AS city FROM {_of("fact_immigration")}
    JOIN {_of("city_code")} ON city_code.code = fact_immigration.city_code
    ORDER BY cic_id, immigration_id LIMIT 10"""
)
def wh_g4_arrivals_with_city(spark, sf_dir):
    return analytics.arrivals_with_city(*stored(spark, sf_dir, "fact_immigration", "city_code"))


@query(
    f"""SELECT * FROM {_of("dim_temperature")}
    ORDER BY avg_temp DESC NULLS LAST, country, city, dt LIMIT 10"""
)
def wh_g5_warmest(spark, sf_dir):
    return analytics.warmest_records(*stored(spark, sf_dir, "dim_temperature"))


@query(f"SELECT dim_temperature.*, code FROM {_of('dim_temperature')} JOIN {_of('city_code')} USING (city)")
def wh_g6_port_temperatures(spark, sf_dir):
    return analytics.port_temperatures(*stored(spark, sf_dir, "dim_temperature", "city_code"))


@query(
    f"SELECT city, round(avg(CAST(avg_temp AS DOUBLE)), 4) AS average_temp FROM {_of('dim_temperature')} GROUP BY city"
)
def wh_g7_mean_by_city(spark, sf_dir):
    means = analytics.mean_temperatures(*stored(spark, sf_dir, "dim_temperature"))
    return means.withColumn("average_temp", F.round("average_temp", 4))


_STAR = ("dim_temperature", "city_code", "fact_immigration")


@query(
    f"""SELECT avg_temp, city, fact_immigration.country AS country, count(*) AS arrivals
    FROM {_of("dim_temperature")} JOIN {_of("city_code")} USING (city)
    JOIN {_of("fact_immigration")} ON fact_immigration.city_code = city_code.code GROUP BY 1, 2, 3"""
)
def wh_g8_temperature_at_arrival(spark, sf_dir):
    return analytics.temperature_at_arrival(*stored(spark, sf_dir, *_STAR))


@query(
    f"""SELECT code AS city_code, city, measurements, arrivals, measurements * arrivals AS pairs,
      round(average_temp, 4) AS average_temp
    FROM {_of("city_code")}
    JOIN (SELECT city, count(*) AS measurements, avg(CAST(avg_temp AS DOUBLE)) AS average_temp
      FROM {_of("dim_temperature")} GROUP BY city) m USING (city)
    JOIN (SELECT city_code AS code, count(*) AS arrivals FROM {_of("fact_immigration")}
      GROUP BY city_code) a USING (code)"""
)
def wh_g8_star_totals(spark, sf_dir):
    totals = analytics.star_totals(*stored(spark, sf_dir, *_STAR))
    return totals.withColumn("average_temp", F.round("average_temp", 4))


@query(
    f"""SELECT city, visa FROM {_of("fact_immigration")}
    JOIN {_of("city_code")} ON city_code.code = fact_immigration.city_code
    WHERE fact_immigration.city_code = 'P7'"""
)
def wh_g9_visa_at_port(spark, sf_dir):
    return analytics.visa_at_port(*stored(spark, sf_dir, "fact_immigration", "city_code"), "P7")


def _preview(name: str) -> Query:
    def run(spark, sf_dir):
        return analytics.first_rows(*stored(spark, sf_dir, name), TABLES[name])

    run.__name__ = f"g10_{name}"
    return run


for _name, _sql in TABLE_SQL.items():
    _spec = TABLES[_name]
    _first = (
        f"WHERE {_spec.id_column} <= 10"
        if _spec.id_column
        else f"ORDER BY {', '.join(_spec.natural_key)} LIMIT 10"
    )
    query(f"SELECT * FROM ({_sql}) t {_first}")(_preview(_name))
