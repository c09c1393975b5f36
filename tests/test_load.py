import random
import shutil
from pathlib import Path

import domain
import pytest

from starquay import staging
from starquay.__main__ import main
from starquay.operators import cleaning
from starquay.plans import analytics, load, quality
from starquay.schemas import RAW_ARRIVALS, RAW_DEMOGRAPHICS, RAW_TEMPERATURE, TABLES
from starquay.session import listed_bytes, size_shuffles, sized_for
from starquay.sources import ledger, readers, sinks, versions

# Rows of each table out of the domain rows.
ROWS = {
    "fact_immigration": 4,
    "dim_immigration_personal": 4,
    "dim_immigration_airline": 4,
    "dim_temperature": 4,
    "dim_demog_population": 6,
    "dim_demog_statistics": 2,
    "country_code": 2,
    "city_code": 3,
    "state_code": 2,
}


@pytest.fixture(scope="module")
def raw(tmp_path_factory, spark):
    """Raw files, as they would be delivered."""
    root = tmp_path_factory.mktemp("raw")
    domain.arrivals(spark).write.parquet(f"{root}/arrivals/2016-04")
    domain.temperatures(spark).write.csv(f"{root}/temperature", header=True)
    domain.demographics(spark).write.csv(f"{root}/demographics", header=True, sep=";")
    (root / "labels.txt").write_bytes(domain.LABELS.encode())
    return root


def paths(raw):
    return {
        "arrivals": f"{raw}/arrivals/*",
        "temperature": f"{raw}/temperature",
        "demographics": f"{raw}/demographics",
        "labels": f"{raw}/labels.txt",
    }


@pytest.fixture(scope="module")
def warehouse(raw, spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    load.full_load(load.read_raw(spark, **paths(raw)), root)
    return root


def contents(spark, root):
    return {
        name: sorted(map(str, readers.read_table(spark, root, name).collect())) for name in TABLES
    }


def publish(spark, root, name, df):
    """A version with other rows for one table, whatever they are."""
    paths = sinks.write_segment(df, root, name)
    versions.publish(spark, root, versions.latest(spark, root), {name: paths})


def test_full_load_passes_its_checks(spark, warehouse):
    assert {r.table_name: r.records for r in load.check(spark, warehouse).collect()} == ROWS


def test_full_load_replaces(spark, raw, warehouse, tmp_path):
    again = load.read_raw(spark, **paths(raw))
    for _ in range(2):
        load.full_load(again, str(tmp_path))
    assert contents(spark, str(tmp_path)) == contents(spark, warehouse)


def test_refresh_adds_only_what_is_new(spark, raw, warehouse, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(warehouse, root)
    known = load.read_raw(spark, **paths(raw))
    load.refresh(spark, known, root)
    assert contents(spark, root) == contents(spark, warehouse)

    later = domain.frame(
        spark, RAW_ARRIVALS, [*domain.ARRIVALS, domain.VISITOR | dict(cicid=5.0), domain.VISITOR | dict(cicid=7.0)]
    )
    warmer = domain.frame(
        spark,
        RAW_TEMPERATURE,
        [*domain.TEMPERATURES, domain.TEMPERATURES[0] | dict(dt="2014-01-01")],
    )
    town = domain.frame(
        spark, RAW_DEMOGRAPHICS, [*domain.DEMOGRAPHICS, domain.TOWN | {"City": "Bend"}]
    )
    more = load.RawFrames(arrivals=later, temperature=warmer, demographics=town)
    for _ in range(2):
        load.refresh(spark, more, root)
        fact = readers.read_table(spark, root, "fact_immigration").orderBy("immigration_id")
        assert [(r.immigration_id, r.cic_id) for r in fact.collect()] == [
            (1, 1), (2, 2), (3, 9), (4, 10), (5, 5), (6, 7),
        ]
        counts = {r.table_name: r.records for r in load.check(spark, root).collect()}
        assert counts == ROWS | {
            "fact_immigration": 6,
            "dim_immigration_personal": 6,
            "dim_immigration_airline": 6,
            "dim_temperature": 5,
            "dim_demog_population": 7,
            "dim_demog_statistics": 3,
        }


def test_command_line(spark, raw, tmp_path, monkeypatch):
    # The session of the tests stays open, and so does what it staged.
    monkeypatch.setattr("starquay.__main__.build_session", lambda: spark)
    monkeypatch.setattr("starquay.__main__.size_shuffles", lambda session, size: None)
    monkeypatch.setattr("starquay.__main__.discard", lambda session: None)
    given = [word for name, path in paths(raw).items() for word in (f"--{name}", path)]
    main([*given, "--output", str(tmp_path)])
    main([*given, "--output", str(tmp_path), "--append"])
    assert {r.table_name: r.records for r in load.check(spark, str(tmp_path)).collect()} == ROWS


def test_one_data_set_is_loaded_and_checked_alone(spark, raw, tmp_path):
    some = load.read_raw(spark, labels=f"{raw}/labels.txt", temperature=f"{raw}/temperature")
    load.full_load(some, str(tmp_path))
    found = load.check(spark, str(tmp_path), load.tables_of(some)).collect()
    names = ["dim_temperature", "country_code", "city_code", "state_code"]
    assert {r.table_name: r.records for r in found} == {name: ROWS[name] for name in names}
    assert list(readers.stored_tables(spark, str(tmp_path))) == names
    assert sorted(name for names in load.TABLES_OF.values() for name in names) == sorted(TABLES)


def test_checks_name_the_table_at_fault(spark, warehouse, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(warehouse, root)
    shutil.rmtree(f"{root}/segments/state_code")
    publish(spark, root, "city_code", spark.range(3))
    with pytest.raises(quality.QualityError) as caught:
        load.check(spark, root)
    assert "state_code: absent" in str(caught.value)
    assert "city_code: expected" in str(caught.value)
    assert "country_code" not in str(caught.value)


def test_checks_find_empty_tables(spark, warehouse, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(warehouse, root)
    publish(spark, root, "city_code", readers.read_table(spark, warehouse, "city_code").where("false"))
    with pytest.raises(quality.QualityError, match="empty tables: city_code"):
        load.check(spark, root)


def test_checks_take_a_table_without_files_and_one_without_partitions(spark, warehouse, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(warehouse, root)
    fact = readers.read_table(spark, warehouse, "fact_immigration")
    publish(spark, root, "fact_immigration", fact.where("false"))
    with pytest.raises(quality.QualityError, match="empty tables: fact_immigration"):
        load.check(spark, root)
    publish(spark, root, "fact_immigration", fact.drop("state_code"))
    with pytest.raises(quality.QualityError, match="fact_immigration: expected"):
        load.check(spark, root)


def test_preview_is_a_filter_in_the_scan(spark, warehouse):
    fact = readers.read_table(spark, warehouse, "fact_immigration")
    first = analytics.first_rows(fact, TABLES["fact_immigration"], 2)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(immigration_id,2)" in plan
    assert first.count() == 2


def test_shuffle_sizes_grow_with_the_input():
    sizes = (1 << 30, 10 << 40, 100 << 40)
    found = [sized_for(size)["spark.sql.shuffle.partitions"] for size in sizes]
    assert found == ["200", "40960", "409600"]
    assert sized_for(100 << 40, max_partitions=100_000)["spark.sql.shuffle.partitions"] == "100000"


def test_shuffles_are_sized_by_the_listed_files(spark, raw, monkeypatch):
    frame = load.read_raw(spark, arrivals=paths(raw)["arrivals"]).arrivals
    size = sum(p.stat().st_size for p in Path(f"{raw}/arrivals").rglob("*.parquet"))
    assert listed_bytes([frame]) >= size
    assert listed_bytes([frame, frame]) == 2 * listed_bytes([frame])
    kept = {key: spark.conf.get(key, None) for key in sized_for(0)}
    try:
        size_shuffles(spark, listed_bytes([frame] * 3) << 30)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 200
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_schema_listing(spark, warehouse):
    tables = readers.stored_tables(spark, warehouse)
    found = quality.schema_listing(spark, tables).where("table_name = 'city_code'")
    assert [tuple(r)[1:] for r in found.collect()] == [(1, "code", "string"), (2, "city", "string")]


def test_questions_on_the_stored_tables(spark, warehouse):
    """Values worked out by hand from the domain rows."""
    table = {name: readers.read_table(spark, warehouse, name) for name in TABLES}
    fact, codes, measured = table["fact_immigration"], table["city_code"], table["dim_temperature"]

    def listed(df):
        return [tuple(row) for row in df.collect()]

    people = analytics.largest_cities(table["dim_demog_population"])
    assert listed(people) == [("Silver Spring", 30908, 82463), ("Akron", 30908, 41869)]
    usage = analytics.visa_type_usage(table["dim_immigration_airline"], fact)
    assert listed(usage) == [("WT", 2), ("B2", 1)]
    assert listed(analytics.city_code_list(codes, 2)) == [("AKR", "AKRON"), ("CAK", "AKRON")]
    found = analytics.arrivals_with_city(fact, codes).select("cic_id", "city")
    assert listed(found) == [(1, "EASTPORT"), (2, "EASTPORT"), (10, "AKRON")]
    assert [r.city for r in analytics.warmest_records(measured, k=1).collect()] == ["HOMER"]
    ports = analytics.port_temperatures(measured, codes).select("avg_temp", "code")
    assert [r.code for r in ports.collect()] == ["AKR", "CAK"] * 3
    means = {r.city: r.average_temp for r in analytics.mean_temperatures(measured).collect()}
    assert means == {"AKRON": pytest.approx(-8.4, abs=1e-6), "HOMER": 20.5}
    at_arrival = analytics.temperature_at_arrival(measured, codes, fact).orderBy("avg_temp")
    assert [tuple(r)[1:] for r in at_arrival.collect()] == [("AKRON", "United States", 1)] * 3
    totals = analytics.star_totals(measured, codes, fact).drop("average_temp")
    assert listed(totals) == [("AKR", "AKRON", 3, 1, 3)]
    assert listed(analytics.visa_at_port(fact, codes)) == [("AKRON", 1)]


def test_published_tables(spark, warehouse):
    sinks.publish_warehouse(spark, warehouse)
    for name in TABLES:
        assert spark.table(name).columns == TABLES[name].schema.names
    assert spark.sql("select max(immigration_id) from fact_immigration").first()[0] == 4


def test_partition_filter_reaches_the_scan(spark, warehouse):
    fact = readers.read_table(spark, warehouse, "fact_immigration")
    plan = fact.where("state_code = 'NJ'").select("cic_id")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(state_code" in plan.toString()
    assert fact.where("state_code = 'NJ'").count() == 2


def test_staging_falls_back_to_the_warehouse(spark):
    class Session:
        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(name, *default):
                return default[0] if default else Session.warehouse

    Session.sparkContext.master, Session.warehouse = "yarn", "hdfs:///warehouse/"
    assert staging.shared_folder(Session()) == "hdfs:///warehouse/staging"
    Session.warehouse = "file:/home/me/spark-warehouse"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())
    Session.sparkContext.master = "local[2]"
    assert staging.shared_folder(Session()) == "file:/home/me/spark-warehouse/staging"
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def staged_folders(spark):
    folder = Path(staging.new_path(spark, "x")).parent
    return set(map(str, folder.glob("*"))) if folder.exists() else set()


def test_a_load_leaves_nothing_staged(spark, raw, tmp_path):
    before = staged_folders(spark)
    load.full_load(load.read_raw(spark, **paths(raw)), str(tmp_path))
    load.refresh(spark, load.read_raw(spark, **paths(raw)), str(tmp_path))
    assert staged_folders(spark) == before


def test_one_scan_of_the_raw_arrivals(spark, raw):
    frame = load.read_raw(spark, arrivals=paths(raw)["arrivals"]).arrivals
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = frame.mapInArrow(count, frame.schema)
    rows = frame.count()
    staged, done = load.stage_arrivals(counted)
    assert (done.before_rows, read.value) == (rows, rows)
    assert staged.count() == done.after_rows == 11


def test_a_refresh_repeats_the_decision_on_sparse_columns(spark, tmp_path):
    """A row with only ``occup`` is empty in a large load, and so in a small refresh."""
    base = [domain.VISITOR | dict(cicid=float(n)) for n in range(40)]
    odd = dict(occup="STU")

    def frame(rows):
        return load.RawFrames(arrivals=domain.frame(spark, RAW_ARRIVALS, rows))

    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    assert "occup" in load.full_load(frame([*base, odd]), whole)
    load.full_load(frame(base), parts)
    load.refresh(spark, frame([base[0], odd]), parts)
    for root in (whole, parts):
        fact = readers.read_table(spark, root, "fact_immigration")
        assert fact.count() == 40 and fact.where("cic_id is null").count() == 0
    assert load.sparse_columns_of(spark, parts) == load.sparse_columns_of(spark, whole)


def rows_of(spark, root, names):
    found = {}
    for name in names:
        df = readers.read_table(spark, root, name)
        df = df.drop(TABLES[name].id_column) if TABLES[name].id_column else df
        found[name] = sorted(map(str, df.collect()))
    return found


def label_text(rng):
    codes = "\n".join(f"'C{rng.randint(1, 4)}' = 'PLACE {rng.randint(1, 9)}'" for _ in range(5))
    return f"value i94prtl\n{codes}\n;\nvalue i94addrl\n{codes}\n;\nvalue i94cntyl\n 7 = 'LAND {rng.randint(1, 9)}'\n;\n"


@pytest.mark.parametrize("seed", range(4))
def test_load_and_refresh_equal_one_load(spark, tmp_path, seed):
    """Random batches of all inputs over few keys, with other values under known keys."""
    rng = random.Random(seed)
    visits = [
        domain.VISITOR | dict(cicid=float(rng.randint(1, 4)), i94mon=float(rng.randint(1, 2)), visatype=rng.choice(["WT", "B2"]))
        for _ in range(24)
    ]
    towns = [
        domain.TOWN | {
            "Race": f"race {rng.randint(1, 2)}", "Foreign-born": str(rng.randint(1, 3)), "City": rng.choice(["A", "a", "B"]),
            "State Code": rng.choice(["MD", "XX"]), "Median Age": rng.choice(["33.8", "33.2", "40"]),
        }
        for _ in range(24)
    ]
    months = [
        domain.MONTH | dict(
            dt=f"2013-0{rng.randint(1, 3)}-01", City=rng.choice(["Akron", "akron", "Homer"]),
            AverageTemperature=str(rng.choice([-3.5, 3.0, 5.0, 12, "warm"])),
            AverageTemperatureUncertainty=str(rng.randint(1, 3)),
        )
        for _ in range(24)
    ]
    texts = [(f"file {n}", label_text(rng)) for n in range(6)]

    def frames(low, high):
        return load.RawFrames(
            domain.frame(spark, RAW_ARRIVALS, visits[low:high]),
            domain.frame(spark, RAW_TEMPERATURE, months[low:high]),
            domain.frame(spark, RAW_DEMOGRAPHICS, towns[low:high]),
            spark.createDataFrame(texts[low // 4 : high // 4], "file string, text string"),
        )

    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")
    load.full_load(frames(0, 24), once)
    load.full_load(frames(0, 8), twice)
    for low, high in ((8, 16), (16, 24), (16, 24)):
        load.refresh(spark, frames(low, high), twice)
    assert rows_of(spark, twice, TABLES) == rows_of(spark, once, TABLES)
    for name in ("dim_demog_population", "dim_demog_statistics"):
        key = TABLES[name].id_column
        ids = [row[0] for row in readers.read_table(spark, twice, name).select(key).collect()]
        assert len(ids) == len(set(ids))


def temperatures(spark, *rows):
    return load.RawFrames(temperature=domain.frame(spark, RAW_TEMPERATURE, [domain.MONTH | row for row in rows]))


def test_a_lower_temperature_takes_the_place_of_the_stored_one(spark, tmp_path):
    root = str(tmp_path)
    load.full_load(temperatures(spark, dict(AverageTemperature="5.0"), dict(AverageTemperature="9", City="Homer")), root)
    load.refresh(spark, temperatures(spark, dict(AverageTemperature="3.0"), dict(AverageTemperature="11", City="Homer")), root)
    found = readers.read_table(spark, root, "dim_temperature").orderBy("city").collect()
    assert [(row.city, row.avg_temp) for row in found] == [("AKRON", 3.0), ("HOMER", 9.0)]


def test_only_files_with_changed_keys_are_written_anew(spark, tmp_path):
    root = str(tmp_path)
    rows = [dict(dt=f"{1900 + n}-01-01", City=f"City {n % 7}", AverageTemperature="9") for n in range(100)]
    raw = temperatures(spark, *rows).temperature.repartition(8, "dt")
    load.full_load(load.RawFrames(temperature=raw), root)
    before = versions.latest(spark, root)
    many = versions.data_files(spark, root, before.tables["dim_temperature"])

    load.refresh(spark, temperatures(spark, dict(dt="2020-01-01", City="new")), root)
    grown = versions.latest(spark, root).tables["dim_temperature"]
    assert set(many) < set(grown)
    if len(many) > 1:
        load.refresh(spark, temperatures(spark, dict(dt="1900-01-01", City="City 0", AverageTemperature="1")), root)
        now = versions.latest(spark, root).tables["dim_temperature"]
        assert len(set(grown) - set(now)) == 1
    assert readers.read_table(spark, root, "dim_temperature").count() == 101
    # Who read the version before still can.
    assert readers.read_table(spark, root, "dim_temperature", before).count() == 100


def test_changed_towns_keep_their_keys(spark, tmp_path):
    def towns(*rows):
        return load.RawFrames(demographics=domain.frame(spark, RAW_DEMOGRAPHICS, [domain.TOWN | row for row in rows]))

    def stored():
        found = readers.read_table(spark, str(tmp_path), "dim_demog_population").collect()
        return {(row.city, row.foreign_born): row.demog_pop_id for row in found}

    load.full_load(towns({"City": "A"}, {"City": "B"}, {"City": "C"}), str(tmp_path))
    assert stored() == {("A", 30908): 1, ("B", 30908): 2, ("C", 30908): 3}
    load.refresh(spark, towns({"City": "B", "Foreign-born": "10"}, {"City": "D"}, {"City": "C", "Foreign-born": "9"}), str(tmp_path))
    # The stored row of C comes first in order, so it stays.
    assert stored() == {("A", 30908): 1, ("B", 10): 2, ("C", 30908): 3, ("D", 30908): 4}


def test_labels_that_are_delivered_again(spark, tmp_path):
    def texts(*pairs):
        return load.RawFrames(labels=spark.createDataFrame(pairs, "file string, text string"))

    def stored():
        return {row.code: row.city for row in readers.read_table(spark, str(tmp_path), "city_code").collect()}

    text = "value i94prtl\n'AKR' = 'OLD, ZZ'\n'CAK' = 'SAME'\n;\nvalue i94addrl\n'A'='B'\n;\nvalue i94cntyl\n1='C'\n;\n"
    load.full_load(texts(("f2", text)), str(tmp_path))
    load.refresh(spark, texts(("f2", text.replace("OLD", "NEW"))), str(tmp_path))
    assert stored() == {"AKR": "NEW", "CAK": "SAME"}
    load.refresh(spark, texts(("f1", text.replace("OLD", "FIRST")), ("f3", text.replace("SAME", "LAST"))), str(tmp_path))
    assert stored() == {"AKR": "OLD", "CAK": "LAST"}


def test_a_refresh_without_news_publishes_nothing(spark, raw, warehouse, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(warehouse, root)
    load.refresh(spark, load.read_raw(spark, **paths(raw)), root)
    assert versions.latest(spark, root).number == versions.latest(spark, warehouse).number


def test_a_load_that_fails_leaves_the_old_tables(spark, raw, warehouse, tmp_path, monkeypatch):
    root = str(tmp_path / "copy")
    shutil.copytree(warehouse, root)
    before = contents(spark, root)
    town = domain.frame(spark, RAW_DEMOGRAPHICS, [domain.TOWN | {"City": "Bend"}])
    more = load.read_raw(spark, **paths(raw))
    more.demographics = town
    write = load.write_segment

    def breaks(df, root, name, *rest):
        if name == "dim_demog_statistics":
            raise OSError("disk gone")
        return write(df, root, name, *rest)

    monkeypatch.setattr(load, "write_segment", breaks)
    with pytest.raises(OSError, match="disk gone"):
        load.full_load(more, root)
    assert contents(spark, root) == before
    monkeypatch.undo()
    with pytest.raises(quality.QualityError, match="empty tables"):
        load.full_load(load.RawFrames(demographics=town.where("false")), root)
    assert contents(spark, root) == before
    load.full_load(more, root)
    assert readers.read_table(spark, root, "dim_demog_population").count() == 1


def test_an_interrupted_load_goes_on(spark, raw, tmp_path, monkeypatch):
    root, listed = str(tmp_path), ledger.list_files(spark, paths(raw))
    write, written, broken = load.write_segment, [], []

    def once(df, root, name, *rest):
        if name == "dim_demog_statistics" and not broken:
            broken.append(name)
            raise OSError("executor gone")
        written.append(name)
        return write(df, root, name, *rest)

    monkeypatch.setattr(load, "write_segment", once)
    with pytest.raises(OSError):
        load.full_load(load.read_raw(spark, **paths(raw)), root, files=listed)
    finished = set(written)
    assert finished and not versions.latest(spark, root).tables
    written.append("again")
    load.full_load(load.read_raw(spark, **paths(raw)), root, files=listed)
    assert set(written[written.index("again") + 1 :]) & finished == set()
    assert {r.table_name: r.records for r in load.check(spark, root).collect()} == ROWS
    assert load.sparse_columns_of(spark, root) is not None
    # Other files are another load, which writes all.
    written.clear()
    load.full_load(load.read_raw(spark, **paths(raw)), root, files=listed.where("input <> 'labels'"))
    assert set(TABLES) < set(written)


def test_two_loads_from_one_version_cannot_both_publish(spark, warehouse, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(warehouse, root)
    base = versions.latest(spark, root)
    versions.publish(spark, root, base, {})
    with pytest.raises(versions.PublishConflict):
        versions.publish(spark, root, base, {})


def test_a_refresh_reads_only_new_files(spark, raw, tmp_path):
    root, files = str(tmp_path / "warehouse"), str(tmp_path / "raw")
    shutil.copytree(raw, files)
    given = paths(files)
    load.full_load(load.read_raw(spark, **given), root, files=ledger.list_files(spark, given))
    known = ledger.ledger(spark, root)
    assert known.count() == ledger.list_files(spark, given).count() and known.where("batch <> 1").count() == 0
    frames, news = load.read_unseen(spark, root, given)
    assert news is None and not any(vars(frames).values())

    later = domain.frame(spark, RAW_ARRIVALS, [domain.VISITOR | dict(cicid=77.0)]).coalesce(1)
    later.write.parquet(f"{files}/arrivals/2016-05")
    (Path(files) / "labels.txt").write_text(domain.LABELS.replace("EASTPORT", "WESTPORT") + " ")
    frames, news = load.read_unseen(spark, root, given)
    assert sorted(row.input for row in news.collect()) == ["arrivals", "labels"]
    assert frames.temperature is None and frames.demographics is None and frames.arrivals.count() == 1
    load.refresh(spark, frames, root, files=news)
    assert readers.read_table(spark, root, "fact_immigration").count() == ROWS["fact_immigration"] + 1
    assert readers.read_table(spark, root, "city_code").where("city = 'WESTPORT'").count() == 1
    assert load.read_unseen(spark, root, given)[1] is None
    assert ledger.ledger(spark, root).where("batch = 2").count() == 2


def test_old_versions_are_removed(spark, warehouse, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(warehouse, root)
    for n in range(4):
        load.refresh(spark, temperatures(spark, dict(dt=f"202{n}-01-01"), dict(dt="2013-03-01", City="Homer", AverageTemperature=str(19 - n))), root)
        sinks.write_segment(spark.range(1), root, "state_code")
    before, size = contents(spark, root), len(list(Path(root).rglob("*.parquet")))
    last = versions.latest(spark, root)
    versions.remove_old(spark, root, keep=1)
    assert versions.latest(spark, root) == last and contents(spark, root) == before
    used = {path for found in last.tables.values() for path in versions.data_files(spark, root, found)}
    plain = {str(p.relative_to(root)) for p in Path(root).rglob("*.parquet") if "state_code=" not in str(p)}
    assert plain == used and len(list(Path(root).rglob("*.parquet"))) < size


def test_profiles_of_batches_add_up(spark, tmp_path):
    rows = [domain.VISITOR | dict(cicid=float(n), gender=None if n % 3 else "F", occup="X" if n < 5 else None) for n in range(30)]
    first, later = (domain.frame(spark, RAW_ARRIVALS, part) for part in (rows[:4], rows[4:]))
    root = str(tmp_path)
    load.full_load(load.RawFrames(arrivals=first), root)
    load.refresh(spark, load.RawFrames(arrivals=later), root)
    whole = domain.frame(spark, RAW_ARRIVALS, rows)
    for ascending in (False, True):
        expected = cleaning.missing_profile(whole, ascending).collect()
        assert load.stored_profile(spark, root, ascending).collect() == expected
    # The first batch was too small to tell.
    assert "occup" not in load.sparse_columns_of(spark, root)
    alone = str(tmp_path / "alone")
    assert load.sparse_on_all_data(spark, root) == sorted(load.full_load(load.RawFrames(arrivals=whole), alone))


def rows_read(df):
    """Rows that the scans of a plan gave."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_a_lookup_skips_what_it_does_not_ask_for(spark, tmp_path):
    ports = [domain.VISITOR | dict(cicid=float(n), i94port=f"P{n % 50:02}", i94addr="NJ") for n in range(60_000)]
    root = str(tmp_path)
    load.full_load(load.RawFrames(arrivals=domain.frame(spark, RAW_ARRIVALS, ports)), root)
    fact = readers.read_table(spark, root, "fact_immigration")
    asked = fact.where("city_code = 'P07'").select("cic_id")
    assert asked.count() == 1200
    assert rows_read(asked) < 30_000
    assert rows_read(fact.where("city_code = 'P07x'").select("cic_id")) == 0


def test_plain_folders_become_part_of_the_first_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    fact = readers.read_table
    spark.createDataFrame([(1, "CA")], "cic_id bigint, state_code string").selectExpr(
        *(f"cast({c if c in ('cic_id', 'state_code') else 'null'} as {t.simpleString()}) as {c}"
          for c, t in ((f.name, f.dataType) for f in TABLES["fact_immigration"].schema))
    ).write.partitionBy("state_code").parquet(f"{root}/fact_immigration")
    load.refresh(spark, load.RawFrames(arrivals=domain.arrivals(spark)), root)
    found = fact(spark, root, "fact_immigration")
    assert found.count() == 5 and found.where("state_code = 'CA'").count() == 1


def test_refresh_of_another_input_than_the_first_load(spark, raw, tmp_path):
    load.full_load(load.read_raw(spark, labels=paths(raw)["labels"]), str(tmp_path))
    load.refresh(spark, load.read_raw(spark, temperature=paths(raw)["temperature"]), str(tmp_path))
    assert readers.read_table(spark, str(tmp_path), "dim_temperature").count() == ROWS["dim_temperature"]
