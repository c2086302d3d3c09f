import gzip
import json

import pytest
from pyspark.sql import functions as F

from urbanstats.schemas import BLOCK_COLUMNS, INCOME_COLUMNS
from urbanstats.sources import (
    feature_properties,
    features,
    read_csv,
    read_csv_by_name,
    read_features,
    rejected_lines,
    scratch_path,
    write_csv,
)


@pytest.fixture
def save(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_of_several_files(spark, save):
    a = save("a.csv", 'DR_NO,TIME OCC,Premis Desc\n1,0130,"x, ""y"" z"\n2,0200\n\n3,0300,q,extra\n')
    b = save("b.csv", "DR_NO,TIME OCC,Premis Desc\n4,0400, STREET \n")
    df = read_csv(spark, [a, b], required=["TIME OCC"])
    assert df.dtypes == [(c, "string") for c in ("DR_NO", "TIME OCC", "Premis Desc")]
    assert tuples(df) == [
        ("1", "0130", 'x, "y" z'),
        ("2", "0200", None),
        ("3", "0300", "q"),
        ("4", "0400", " STREET "),
    ]
    assert df.count() == 4
    assert tuples(df.select("Premis Desc").filter("`Premis Desc` = 'q'")) == [("q",)]


def test_csv_missing_column(spark, save):
    path = save("a.csv", "Zip Code;x\n1;2\n")
    with pytest.raises(ValueError, match="Estimated Median Income"):
        read_csv(spark, path, sep=";", required=INCOME_COLUMNS)


def test_csv_header_in_another_order(spark, save):
    a, b = save("a.csv", "k,v\n1,2\n"), save("b.csv", "v,k\n3,4\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, [a, b]).collect()
    assert tuples(read_csv_by_name(spark, [a, b])) == [("1", "2"), ("4", "3")]
    c = save("c.csv", "v,k,w\n5,6,7\n")
    got = read_csv_by_name(spark, [[a], c])
    assert tuples(got) == [("1", "2", None), ("6", "5", "7")]


def test_csv_with_given_columns_drops_header_lines(spark, save):
    path = save("a.csv", 'k,v\n1,"a;b, c"\nk,v\n\n2\n,only v\n')
    got = read_csv(spark, path, columns=["k", "v"])
    assert tuples(got) == sorted([("1", "a;b, c"), ("2", None), (None, "only v")], key=repr)


LONG = [
    "2,b,EXTRA,MORE",
    "3,b,",
    '4,"a, ""b"" c",x',
    '5, "p,q" ,,',
    ",,,,",
    '6,5" pipe,z',
    '7,"","",""',
]
FITTING = ['8,"x, y"', "9", "10,", '"11,a","b""c"', ',"only, v"', '12,5" pipe', " 13 , b "]


@pytest.mark.parametrize("columns", [None, ["k", "v"]])
def test_lines_with_too_many_fields(spark, save, columns):
    """Rejected lines come out whole, with their count; all others are good rows."""
    lines = [x for pair in zip(LONG, FITTING) for x in pair]
    path = save("long.csv", "k,v\n\n" + "\n".join(lines) + "\n")
    rejected = rejected_lines(spark, path, columns=columns)
    assert rejected.columns == ["line", "fields", "file"]
    found = {r["line"]: r["fields"] for r in rejected.collect()}
    assert found == dict(zip(LONG, [4, 3, 3, 4, 5, 3, 4]))
    assert {r["file"].rsplit("/", 1)[1] for r in rejected.collect()} == {"long.csv"}
    good = read_csv(spark, path, columns=columns, long_lines="drop")
    clean = save("clean.csv", "k,v\n" + "\n".join(FITTING) + "\n")
    assert good.columns == ["k", "v"]
    assert tuples(good) == tuples(read_csv(spark, clean, columns=columns))
    assert tuples(good.select("v")) == tuples(read_csv(spark, clean, columns=columns).select("v"))
    assert good.count() == len(FITTING)
    assert tuples(read_csv(spark, clean, columns=columns, long_lines="raise")) == tuples(good)
    with pytest.raises(Exception, match="fields instead of 2"):
        read_csv(spark, path, columns=columns, long_lines="raise").collect()
    with pytest.raises(Exception, match="fields instead of 2"):
        read_csv(spark, path, columns=columns, long_lines="raise").select("k").count()
    assert read_csv(spark, path, columns=columns).count() == len(lines)


def test_long_lines_with_other_separators(spark, save):
    for sep in (";", "|", "\t", "||"):
        path = save("sep.csv", sep.join("kv") + "\n" + sep.join("123") + "\n" + sep.join("45") + "\n")
        assert [r["fields"] for r in rejected_lines(spark, path, sep=sep).collect()] == [3]
        assert tuples(read_csv(spark, path, sep=sep, long_lines="drop")) == [("4", "5")]


def test_long_lines_arguments(spark, save):
    path = save("a.csv", "_line,v\n1,2\n3,4,5\n")
    with pytest.raises(ValueError, match="long lines"):
        read_csv(spark, path, long_lines="keep")
    assert tuples(read_csv(spark, path, long_lines="drop")) == [("1", "2")]
    with pytest.raises(ValueError, match="missing"):
        read_csv(spark, path, long_lines="drop", required=["w"])
    other = save("b.csv", "v,_line\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, [path, other], long_lines="drop").collect()


LONG_VALUES = [
    ("1", "a\nb"),
    ("2", 'x "quoted\n\n" y,\n'),
    ("3", "win\r\nline"),
    ("4", "plain, with comma"),
    ("5", None),
    ("6", "\n" * 40 + "z" * 90),
    ("k\n2", "\r"),
]


@pytest.mark.parametrize("size", ["37", "1000000"])
@pytest.mark.parametrize("columns", [None, ["k", "v,w"]])
def test_line_ends_in_values(spark, tmp_path, conf, size, columns):
    """What the sink writes comes back, wherever the files are cut."""
    rows = LONG_VALUES * 2
    path = str(tmp_path / "r")
    names = ["k", "v,w"]
    df = spark.createDataFrame(rows, "k string, `v,w` string").repartition(2)
    write_csv(df, path)
    conf(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="0")
    got = read_csv(spark, path, columns=columns, line_ends_in_values=True)
    assert got.columns == names
    assert tuples(got) == sorted(rows, key=repr)
    assert tuples(got.select("k")) == sorted(((k,) for k, _ in rows), key=repr)
    if size != "1000000":
        assert spark.read.text(path).select(F.spark_partition_id()).distinct().count() > 8


def test_line_ends_by_a_shuffle(spark, save, monkeypatch, conf):
    """Beyond so many splits lines meet their splits by a shuffle, in order."""
    from urbanstats.sources import records

    monkeypatch.setattr(records, "MAX_BROADCAST_SPLITS", 0)
    conf(spark__sql__files__maxPartitionBytes="40", spark__sql__files__openCostInBytes="0")
    lines = [f'{i},"a\n{i}"' for i in range(60)]
    path = save("s.csv", "k,v\n" + "\n".join(lines))
    got = tuples(read_csv(spark, path, line_ends_in_values=True))
    assert got == sorted((str(i), f"a\n{i}") for i in range(60))


def test_line_ends_and_odd_files(spark, save):
    a = save("o/a.csv", 'k,v\r\n1,"x\r\ny"\r\n\r\n2\r\n3,b,"c\nd"\r\n')
    save("o/b.csv", "k,v\n")
    folder = a.rsplit("/", 1)[0]
    want = [("1", "x\r\ny"), ("2", None), ("3", "b")]
    assert tuples(read_csv(spark, folder, line_ends_in_values=True)) == want
    assert tuples(read_csv(spark, folder, line_ends_in_values=True, long_lines="drop")) == want[:2]
    with pytest.raises(Exception, match="fields instead of 2"):
        read_csv(spark, folder, line_ends_in_values=True, long_lines="raise").collect()
    other = save("c.csv", "v,k\n1,2\n")
    with pytest.raises(Exception, match="does not conform"):
        read_csv(spark, [a, other], line_ends_in_values=True).collect()
    unclosed = save("d.csv", 'k,v\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="not closed"):
        read_csv(spark, unclosed, line_ends_in_values=True).collect()


def test_csv_split_over_tasks(spark, save, conf):
    """The same rows come whatever the splits, also across quoted fields."""
    lines = [f'{i},"a, ""{i}"" b",{"x" * (i % 50)}' for i in range(2000)]
    path = save("big.csv", "k,v,w\n" + "\n".join(lines) + "\n")
    want = tuples(read_csv(spark, path))
    conf(spark__sql__files__maxPartitionBytes="1000", spark__sql__files__openCostInBytes="0")
    split = read_csv(spark, path)
    assert split.select(F.spark_partition_id()).distinct().count() > 20
    assert tuples(split) == want and len(want) == 2000


# GeoJSON.

FEATURES = [
    ("90001", 10, 4),
    ("90001", None, 3),
    ("90002", "0", 5.0),
    ("", 7, 2),
    (None, 9, 1),
    ('a "Feature" \\ {"type": "Feature"}', 8, 2),
]


def feature(zip_code, people, homes):
    return {
        "type": "Feature",
        "geometry": {"type": "Polygon", "coordinates": [[[1.5, 2.5], [3.5, 4.5]]]},
        "properties": {"ZCTA20": zip_code, "other": ["x"], "POP20": people, "HOUSING20": homes},
    }


def document(features):
    return {"type": "FeatureCollection", "name": "blocks", "features": features}


WANT = sorted(
    [(z, None if p is None else str(p), None if h is None else str(h)) for z, p, h in FEATURES],
    key=repr,
)


def read(spark, path, layout):
    return tuples(feature_properties(read_features(spark, path, layout=layout)))


@pytest.mark.parametrize("layout", ["split", "document", "document_lines"])
def test_compact_document(spark, save, layout):
    text = json.dumps(document([feature(*f) for f in FEATURES]), separators=(",", ":"))
    assert read(spark, save("g.json", text), layout) == WANT


@pytest.mark.parametrize("layout", ["split", "document"])
def test_pretty_document(spark, save, layout):
    text = json.dumps(document([feature(*f) for f in FEATURES]), indent=2)
    assert read(spark, save("g.json", text), layout) == WANT


@pytest.mark.parametrize("layout", ["split", "document", "feature_lines"])
def test_document_with_one_feature_per_line(spark, save, layout):
    lines = ",\n".join(json.dumps(feature(*f)) for f in FEATURES)
    text = '{\n"type": "FeatureCollection",\n"features": [\n' + lines + "\n]\n}\n"
    assert read(spark, save("g.json", text), layout) == WANT


@pytest.mark.parametrize("layout", ["split", "feature_lines"])
def test_bare_feature_lines(spark, save, layout):
    text = "\n".join(json.dumps(feature(*f)) for f in FEATURES) + "\n"
    assert read(spark, save("g.json", text), layout) == WANT


@pytest.mark.parametrize("layout", ["split", "document"])
def test_several_documents_some_empty(spark, save, layout):
    save("d/a.json", json.dumps(document([feature(*f) for f in FEATURES[:2]])))
    save("d/b.json", json.dumps(document([feature(*f) for f in FEATURES[2:]])))
    save("d/c.json", json.dumps(document([])))
    folder = save("d/e.json", json.dumps(document(None))).rsplit("/", 1)[0]
    assert read(spark, folder, layout) == WANT


def test_split_reader_at_any_cut(spark, save, conf):
    """A document larger than a split gives the same features, each once."""
    rows = [(f"z{i}", i, i % 7) for i in range(1500)]
    for name, indent in (("compact.json", None), ("pretty.json", 1)):
        path = save(name, json.dumps(document([feature(*r) for r in rows]), indent=indent))
        for size in ("777", "4096", "1000000"):
            conf(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="0")
            df = read_features(spark, path)
            got = tuples(feature_properties(df))
            assert got == sorted([(z, str(p), str(h)) for z, p, h in rows], key=repr)
        conf(spark__sql__files__maxPartitionBytes="4096")
        assert read_features(spark, path).select(F.spark_partition_id()).distinct().count() > 20


DOCUMENTS = ["split", "document", "document_lines"]


@pytest.mark.parametrize("layout", DOCUMENTS)
def test_members_in_any_order(spark, save, layout):
    """Late types, texts such as marks, and members of the document itself."""
    system = {"type": "name", "properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}
    late_system = {"properties": {"name": 'a "}" ]'}, "type": "name"}
    kinds = [{"ZCTA20": str(i), "kind": "Feature", "note": 'a "properties" }{'} for i in range(3)]
    first = [{"properties": k, "type": "Feature"} for k in kinds]
    last = [{"type": "Feature", "geometry": None, "properties": {"ZCTA20": "9"}, "id": 4}]
    nothing = [{"properties": {"note": "a}b"}, "type": "Feature"}, {"type": "Feature", "properties": None}]
    collections = [
        {"crs": system, "features": first, "type": "FeatureCollection"},
        {"type": "FeatureCollection", "features": last + nothing, "crs": system},
        {"features": last, "crs": late_system, "bbox": [1, 2]},
    ]
    for i, collection in enumerate(collections):
        folder = save(f"any/{i}.json", json.dumps(collection)).rsplit("/", 1)[0]
    want = [("0", None, None), ("1", None, None), ("2", None, None), ("9", None, None), ("9", None, None)]
    assert read(spark, folder, layout) == sorted(want + [(None, None, None)] * 2, key=repr)


def test_text_is_read_once(spark, save, plan):
    """The checked reader scans the text in one job; what it gives back is no text."""
    path = save("once.json", json.dumps(document([feature(*f) for f in FEATURES])))
    df = read_features(spark, path)
    assert "Scan text" not in plan(df) and "Scan parquet" in plan(df)
    assert plan(read_features(spark, path, check=False)).count("Scan text") == 2
    assert tuples(feature_properties(df)) == WANT


def test_brackets_within_texts(spark, save):
    """They do not count, with escapes or without; brackets outside do."""
    texts = ["}", "]]", "{[", 'a "}" b', "\\", '\\" ]', "{", "é}", ""]
    rows = [dict(feature(str(i), i, 1), note=t) for i, t in enumerate(texts)]
    whole = json.dumps(document(rows), ensure_ascii=False)
    want = sorted((str(i), str(i), "1") for i in range(len(texts)))
    assert read(spark, save("b.json", whole), "split") == want
    for i, cut in enumerate(("]}", "}", "]")):
        odd = whole[: len(whole) - len(cut)] if whole.endswith(cut) else whole.replace("]]]", "]]", 1)
        with pytest.raises(ValueError, match="cut short"):
            read_features(spark, save(f"b{i}.json", odd))


@pytest.mark.parametrize("layout", DOCUMENTS)
def test_cut_documents_raise(spark, save, layout):
    text = json.dumps(document([feature(*f) for f in FEATURES[:3]]))
    cuts = {len(text) - 1, len(text) - 2, text.index("geometry") + 40, text.rindex("POP20") + 3}
    cuts |= {text.rindex("coordinates") + 30, text.rindex('{"type": "Feature"') - 2}
    for cut in cuts:
        path = save(f"cut{cut}.json", text[:cut])
        with pytest.raises(Exception):
            read_features(spark, path, layout=layout).collect()


@pytest.mark.parametrize("layout", DOCUMENTS)
def test_malformed_features_raise(spark, save, layout):
    text = json.dumps(document([feature(*f) for f in FEATURES[:3]]))
    path = save("bad.json", text.replace('"POP20": null', '"POP20": nul}', 1))
    with pytest.raises(Exception):
        read_features(spark, path, layout=layout).collect()


def test_cut_lines_raise(spark, save):
    lines = [json.dumps(feature(*f)) for f in FEATURES[:3]]
    for cut in (5, 60, len(lines[1]) - 3):
        path = save(f"lines{cut}.json", "\n".join([lines[0], lines[1][:cut], lines[2]]))
        with pytest.raises(Exception):
            read_features(spark, path, layout="feature_lines").collect()


def test_lines_with_document_members(spark, save):
    lines = ",\n".join(json.dumps(feature(*f)) for f in FEATURES)
    system = '"crs": { "type": "name", "properties": { "name": "urn" } },'
    text = '{\n"type": "FeatureCollection",\n' + system + '\n"features": [\n' + lines + "\n]\n}\n"
    assert read(spark, save("g.json", text), "feature_lines") == WANT
    text = '{"type": "FeatureCollection", "features": [\n' + lines + "\n]}\n"
    assert read(spark, save("h.json", text), "feature_lines") == WANT


def test_marks_that_are_no_members_raise(spark, save):
    """What cannot be cut is refused by the split reader and read by the other."""
    for odd in ({"ZCTA20": "1", "k": "properties"}, {"k": {"properties": 1}, "ZCTA20": "1"}):
        path = save("odd.json", json.dumps(document([{"type": "Feature", "properties": odd}])))
        with pytest.raises(Exception):
            read_features(spark, path).collect()
        assert read(spark, path, "document") == [("1", None, None)]


def test_csv_row_that_starts_like_the_header_stays(spark, save):
    path = save("r.csv", "id,note\n1,x\nid,real\nid,note\nid\nid,\n")
    assert tuples(read_csv(spark, path, columns=["id", "note"])) == [("1", "x"), ("id", "real")]


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="unknown layout"):
        read_features(spark, "x", layout="xml")


def test_geometry_is_not_read(spark, save):
    path = save("g.json", json.dumps(document([feature(*FEATURES[0])])))
    for layout in ("split", "document"):
        df = read_features(spark, path, BLOCK_COLUMNS, layout)
        assert df.dtypes == [
            ("feature", "struct<properties:struct<ZCTA20:string,POP20:string,HOUSING20:string>>")
        ]


def test_properties_renamed(spark, save):
    path = save("g.json", json.dumps(document([feature(*FEATURES[0])])))
    got = feature_properties(read_features(spark, path), {"ZCTA20": "zip"})
    assert got.columns == ["zip"] and got.collect() == [("90001",)]


def test_scratch_path_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b and a.endswith("/t")
    if base:
        assert a.startswith(base)


def test_scratch_path_without_a_shared_folder():
    """A local session gets a temporary folder, a cluster an error."""

    class Session:
        def __init__(self, **settings):
            self.conf = settings

    assert scratch_path(Session(**{"spark.master": "local[2]"}), "t").endswith("/t")
    shared = {"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://x/y/"}
    assert scratch_path(Session(**shared), "t").startswith("hdfs://x/y/urbanstats/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(**{"spark.master": "yarn"}), "t")


def test_documents_in_any_order_are_bounded(spark, monkeypatch):
    from workload import derive

    monkeypatch.setattr(derive, "FEATURES_PER_DOCUMENT", 10)
    path = derive.save_feature_documents_any_order(spark.range(500, numPartitions=3), ["id"], "bounded")
    sizes = [r["n"] for r in spark.read.json(path).select(F.size("features").alias("n")).collect()]
    assert sum(sizes) == 500 and max(sizes) <= 10


NUMBERS = [("1.50", "1E5", '{"x": 1.50,  "y": [1]}'), ("-0", "12345678901234567890123", "true")]


def numbers_document(rows):
    parts = [f'{{"properties": {{"ZCTA20": {a}, "POP20": {b}, "HOUSING20": {c}}}}}' for a, b, c in rows]
    return f'{{"type": "FeatureCollection", "features": [{", ".join(parts)}]}}'


@pytest.mark.parametrize("largest", [10, 1_000_000])
def test_numbers_of_a_document_stay_as_they_are_written(spark, save, monkeypatch, largest):
    """Also in documents that are too large to be read as one text, and beside such ones."""
    monkeypatch.setattr(features, "DOCUMENT_TEXT_BYTES", largest)
    folder = save("n/a.json", numbers_document(NUMBERS)).rsplit("/", 1)[0]
    save("n/b.json", numbers_document([("7", "8", "9")]) + "\n")
    save("n/empty.json", "")
    assert read(spark, folder, "document") == sorted([*NUMBERS, ("7", "8", "9")], key=repr)


def test_sizes_around_the_largest_text(spark, save, monkeypatch):
    """Documents of two sizes in one folder come once each, by either way."""
    rows = [(str(i), str(i), str(i)) for i in range(40)]
    folder = save("m/a.json", numbers_document(rows[:1])).rsplit("/", 1)[0]
    save("m/b.json", numbers_document(rows[1:]))
    monkeypatch.setattr(features, "DOCUMENT_TEXT_BYTES", 500)
    df = read_features(spark, folder, layout="document")
    assert tuples(feature_properties(df)) == sorted(rows, key=repr)
    assert df.sparkSession.conf.get("spark.sql.files.openCostInBytes") == spark.conf.get(
        "spark.sql.files.openCostInBytes"
    )


def test_compressed_documents(spark, save):
    path = save("z/a.json", numbers_document([("7", "8", "9")]))
    with gzip.open(path + ".gz", "wt") as f:
        f.write(numbers_document([("10", "11", "x")]).replace("x", '"x"'))
    got = read(spark, path.rsplit("/", 1)[0], "document")
    assert got == sorted([("7", "8", "9"), ("10", "11", "x")], key=repr)


def test_documents_in_other_encodings_raise(spark, save):
    """Not silently without numbers: a text of two bytes a character has zero bytes."""
    path = save("u.json", "")
    for encoding in ("utf-16", "utf-16-le", "utf-16-be", "utf-32"):
        with open(path, "wb") as f:
            f.write(numbers_document(NUMBERS).encode(encoding))
        with pytest.raises(Exception):
            read_features(spark, path, layout="document").collect()


def test_document_with_numbers_is_read_once(spark, save):
    """Not once more for every number: the reader's bytes follow the size of the file."""
    rows = [(str(i), str(i), str(i % 7)) for i in range(3000)]
    text = numbers_document(rows)
    path = save("once_only.json", text)

    def bytes_read():
        statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
        return sum(s.getBytesRead() for s in statistics)

    before = bytes_read()
    assert len(read(spark, path, "document")) == 3000
    assert bytes_read() - before < 4 * len(text)
