import random

import pytest

from starquay.operators import labels
from starquay.plans.tables import code_tables
from starquay.sources.readers import read_text_splits, read_texts, text_lines

TEXT = "\r\n".join(
    [
        "libname library 'somewhere' ;",
        "proc format library=library ;",
        "/* codes: the value of each */",
        "  value i94cntyl",
        "   817 =  'LOWER NOWHERE, isles (by sea, see 7) and others'",
        "   430 =  'UPPER NOWHERE'",
        "   996 =  'No Country Code (996)' ;",
        "",
        "/* 1 = 'not an entry' */",
        "   2 = 'after the end'",
        "  value $i94prtl",
        "   'QUA'\t=\t'QUARTZ, ZZ             '",
        "   'ROW'\t=\t'ROWAN, ZZ             '           ",
        "   'TOM'\t=\t'TOM''S CREEK, YY      '",
        "   'CP '\t=\t'No PORT Code (CP)'",
        "   'ADU' \t=\t'semi; colon, XX'",
        ";",
        "value i94model",
        "\t1 = 'Air'",
        "\t9 = 'Not reported' ;",
        "value i94addrl",
        "\t'EA'='EASTMARCH'",
        "\t'WE'='WESTMARCH' ",
        "\t'99'='ANYWHERE ELSE' ;",
        "/* 3 = Student */",
    ]
)


def entries(spark, *texts):
    rows = [(f"file-{n}", text) for n, text in enumerate(texts)]
    return labels.label_entries(spark.createDataFrame(rows, "file string, text string"))


def listed(df):
    return sorted(tuple(row) for row in df.collect())


def test_sections_and_entries(spark):
    found = entries(spark, TEXT).orderBy("position").collect()
    assert [(r.section, r.code, r.label) for r in found] == [
        ("i94cntyl", "817", "LOWER NOWHERE, isles (by sea, see 7) and others"),
        ("i94cntyl", "430", "UPPER NOWHERE"),
        ("i94cntyl", "996", "No Country Code (996)"),
        ("i94prtl", "QUA", "QUARTZ, ZZ"),
        ("i94prtl", "ROW", "ROWAN, ZZ"),
        ("i94prtl", "TOM", "TOM'S CREEK, YY"),
        ("i94prtl", "CP", "No PORT Code (CP)"),
        ("i94prtl", "ADU", "semi; colon, XX"),
        ("i94model", "1", "Air"),
        ("i94model", "9", "Not reported"),
        ("i94addrl", "EA", "EASTMARCH"),
        ("i94addrl", "WE", "WESTMARCH"),
        ("i94addrl", "99", "ANYWHERE ELSE"),
    ]


def test_code_lists(spark):
    found = entries(spark, TEXT)
    assert ("817", "LOWER NOWHERE, isles (by sea, see 7) and others") in listed(
        labels.country_codes(found)
    )
    assert listed(labels.city_codes(found)) == [
        ("ADU", "semi; colon"),
        ("CP", "No PORT Code (CP)"),
        ("QUA", "QUARTZ"),
        ("ROW", "ROWAN"),
        ("TOM", "TOM'S CREEK"),
    ]
    assert listed(labels.state_codes(found)) == [
        ("99", "ANYWHERE ELSE"),
        ("EA", "EASTMARCH"),
        ("WE", "WESTMARCH"),
    ]


def test_unix_lines_and_no_last_semicolon(spark):
    text = TEXT.replace("\r\n", "\n").replace("'ANYWHERE ELSE' ;\n/* 3 = Student */", "'Other'")
    assert ("99", "Other") in listed(labels.state_codes(entries(spark, text)))


def test_last_entry_of_a_code_wins(spark):
    again = "value i94addrl\n 'EA'='first'\n 'EA'='second';\n"
    assert ("EA", "second") in listed(labels.state_codes(entries(spark, TEXT, again)))
    assert ("EA", "EASTMARCH") in listed(labels.state_codes(entries(spark, again, TEXT)))


def test_long_section(spark):
    lines = "\r\n".join(f"   {n} =  'COUNTRY {n}, with ''quotes'''" for n in range(20000))
    found = labels.country_codes(entries(spark, f"  value i94cntyl\r\n{lines} ;\r\n"))
    assert found.count() == 20000


def test_any_label_survives_the_round_trip(spark):
    rng = random.Random(5)
    signs = "ab Z9,;=()'.-&/"
    texts, expected = [], []
    for n in range(200):
        lines = []
        for code in rng.sample(range(1000), rng.randint(1, 12)):
            label = "".join(rng.choice(signs) for _ in range(rng.randint(1, 30))).strip() or "x"
            expected.append((f"file-{n}", f"s{n}", str(code), label))
            pad = " " * rng.randint(0, 4)
            quote = rng.choice(["", "'"])
            doubled = label.replace("'", "''")
            lines.append(f"{pad}{quote}{code}{quote}{pad}=\t'{doubled}{pad}'{pad}")
        end = rng.choice([" ;", "\n;", ""])
        texts.append(f"/* text {n} */\n value s{n}\n" + "\n".join(lines) + end + "\n")
    found = entries(spark, *texts).select("file", "section", "code", "label")
    assert listed(found) == sorted(expected)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_a_long_text_is_parsed_in_splits(spark, tmp_path, small_splits):
    """The same entries, in the same order, as from the whole text, wherever it is split."""
    rng = random.Random(7)
    for name in ("a", "b"):
        lines = ["/* head 'Z' = 'before any section' */", "'Y'='nor this'"]
        for n in range(120):
            lines.append(
                rng.choice([f" value $s{n % 5}", f"'C{n % 9}' = 'it''s {n}, or so'", f" {n} =\t'N {n}' ;", ";", "", " junk ; ", f"'D{n}'='semi; {n};'"])
            )
        (tmp_path / f"{name}.sas").write_bytes(rng.choice(["\n", "\r\n"]).join(lines).encode())
    path = f"{tmp_path}/*.sas"
    parts = read_text_splits(spark, path)
    assert parts.select("file", "split").distinct().count() > 10
    found, whole = labels.label_entries_of_splits(parts), labels.label_entries(read_texts(spark, path))
    assert found.columns == whole.columns and found.dtypes == whole.dtypes

    def in_order(df):
        return [(r.file, r.section, r.code, r.label) for r in df.orderBy("file", "position").collect()]

    assert in_order(found) == in_order(whole) != []
    last = [labels.last_entries(df).select("section", "code", "label") for df in (found, whole)]
    assert listed(last[0]) == listed(last[1])


def test_splits_of_nothing(spark):
    empty = spark.createDataFrame([], "file string, split bigint, row bigint, line string")
    assert labels.entries_of(empty).collect() == []


def test_placeholders_are_flagged_not_dropped(spark):
    found = labels.country_codes(entries(spark, TEXT))
    flagged = found.where(labels.is_placeholder(found["country"]))
    assert [row.code for row in flagged.collect()] == ["996"]
    assert found.count() == 3


def test_files_are_read_whole(spark, tmp_path):
    (tmp_path / "a.sas").write_bytes(TEXT.encode())
    (tmp_path / "b.sas").write_bytes(b"value i94addrl\n'ZZ'='LAST ONE'\n;\n")
    texts = read_texts(spark, str(tmp_path / "*.sas"))
    assert texts.count() == 2
    assert code_tables(texts)["state_code"].count() == 4
    lines = text_lines(texts, "file").where("file like '%a.sas'").orderBy("line_no").collect()
    assert [row.line for row in lines] == TEXT.split("\r\n")
    assert [row.line_no for row in lines] == list(range(len(lines)))
