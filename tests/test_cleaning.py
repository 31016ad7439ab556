"""Reading and cleaning labelled files: labels, odd numbers, bad lines, encodings, categories."""

import random

import pytest
from pyspark.sql import functions as F

from flowlake import schema as S
from flowlake.functions import expressions as X
from flowlake.operators import cleaning as C
from flowlake.sources import csv_flows as R

HEADER = " Flow Duration,Fwd Header Length, Flow Bytes/s,Fwd Header Length, Label\n"


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize(
    "text,expected",
    [("1.5", 1.5), (" 7 ", 7.0), ("1e3", 1000.0), ("abc", None), ("Infinity", None), ("-inf", None),
     ("NaN", None), ("", None), (None, None), ("1.5d", None), ("2F", None)],
)
def test_numbers(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string").select(C.number(F.col("x")).alias("y"))
    assert df.first().y == expected


@pytest.mark.parametrize(
    "text,expected", [("BENIGN", 0), (" BENIGN\t", 0), ("benign", 1), ("DDoS", 1), (None, 1), ("", 1)]
)
def test_binary_label(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string").select(X.binary_label(F.col("x")).alias("y"))
    assert df.first().y == expected


def test_numeric_labels_are_kept(spark):
    df = spark.createDataFrame([(0,), (1,), (3,)], "Label int")
    assert [r.label for r in C.with_binary_label(df).collect()] == [0, 1, 3]


def test_one_file(spark, tmp_path):
    body = "10,1,5.0,1,BENIGN\n11,1,Infinity,1,DDoS\n12,1,NaN,1,DDoS\n13,1,x,1,DDoS\n14,1,6,1,\tBENIGN \n15,1,7,1,benign\n16,1,8,1,\n"
    path = write(tmp_path, "a.csv", HEADER + body)
    df = R.read_flow_csv(spark, path)
    assert rows(df, "flow_duration", "flow_bytes_s", "label") == [
        (10.0, 5.0, 0), (14.0, 6.0, 0), (15.0, 7.0, 1), (16.0, 8.0, 1)
    ]


def test_long_lines_go_short_lines_stay(spark, tmp_path):
    body = '10,1,5,1,"Bot, net"\n11,1,5,1,DDoS,more\n12,1,5,1,DDoS,\n13,1,5\n14,1,5,1,BENIGN\n'
    path = write(tmp_path, "a.csv", HEADER + body)
    df = R.read_flow_csv_sampled(spark, str(tmp_path), per_source=None)
    # the short line has its features but no label, so it counts as an attack
    assert rows(df, "flow_duration", "label_text") == [(10.0, "Bot, net"), (13.0, "nan"), (14.0, "BENIGN")]
    assert rows(R.read_flow_csv(spark, path), "flow_duration", "label") == [(10.0, 1), (13.0, 1), (14.0, 0)]


def test_numeric_label_file(spark, tmp_path):
    path = write(tmp_path, "cache.csv", "Flow Duration,Label\n1,0\n2,1\n")
    assert rows(R.read_flow_csv(spark, path), "flow_duration", "label") == [(1.0, 0), (2.0, 1)]


def test_folder_variants(spark, tmp_path):
    write(tmp_path, "a.csv", "Flow Duration,Label\n1,BENIGN\n2,DDoS\n")
    write(tmp_path, "b.csv", "Flow Duration, LABEL\n3,BENIGN\n")
    write(tmp_path, "c.csv", "Flow Duration\n4\n")
    write(tmp_path, "dataset.csv", "Flow Duration,Label\n5,0\n")
    df = R.read_flow_csv_sampled(spark, str(tmp_path), per_source=None)
    assert rows(df, "source_file", "flow_duration", "label") == [
        ("a.csv", 1.0, 0), ("a.csv", 2.0, 1), ("b.csv", 3.0, 0)
    ]
    assert R.read_flow_csv_sampled(spark, str(tmp_path / "none"), per_source=None) is None


def test_merged_folder_uses_one_label_spelling(spark, tmp_path):
    write(tmp_path, "a.csv", "Flow Duration,Label\n1,BENIGN\n")
    write(tmp_path, "b.csv", "Flow Duration,label\n2,BENIGN\n")
    df = R.read_flow_csv_dir(spark, str(tmp_path))
    assert rows(df, "flow_duration", "label") == [(1.0, 0), (2.0, 1)]


def test_merged_folder_nulls_missing_columns(spark, tmp_path):
    write(tmp_path, "a.csv", "Flow Duration,Flow Bytes/s,Label\n1,9,BENIGN\n")
    write(tmp_path, "b.csv", "Label,Flow Duration\nBENIGN,2\n")
    # the second file lacks a feature the merged table has: its rows are incomplete
    assert rows(R.read_flow_csv_dir(spark, str(tmp_path)), "flow_duration") == [(1.0,)]


def test_latin1_and_utf8_labels(spark, tmp_path):
    write(tmp_path, "a.csv", "Flow Duration,Label\n1,Web Attack \x96 XSS\n", "latin-1")
    write(tmp_path, "b.csv", "Flow Duration,Label\n2,Web Attack – XSS\n")
    df = R.read_flow_csv_sampled(spark, str(tmp_path), per_source=None)
    assert rows(df, "flow_duration", "label_text") == [(1.0, "Web Attack \x96 XSS"), (2.0, "Web Attack – XSS")]


def test_sampled_folder_is_exact(spark, tmp_path):
    labels = ["BENIGN"] * 8 + ["DDoS", "Bot"]
    body = "".join(f"{i},{label}\n" for i, label in enumerate(labels))
    write(tmp_path, "a.csv", "Flow Duration,Label\n" + body)
    write(tmp_path, "b.csv", "Flow Duration,Label\n1,BENIGN\n2,BENIGN\n")
    df = R.read_flow_csv_sampled(spark, str(tmp_path), per_source=5)
    counts = {(r.source_file, r.label_text): r["count"] for r in df.groupBy("source_file", "label_text").count().collect()}
    assert counts == {("a.csv", "BENIGN"): 4, ("a.csv", "DDoS"): 1, ("a.csv", "Bot"): 1, ("b.csv", "BENIGN"): 2}


def test_mixed_file(spark, tmp_path):
    text = (
        "id, proto ,service,dur,srcip,dstip,attack_cat,label\n"
        "1,tcp,http,1.0,a,b,none,0\n2,udp,,2.0,a,b,Fuzzers,1\n3,arp,dns,inf,a,b,none,0\n4,tcp,dns,4,a,b,none,1\n"
    )
    path = write(tmp_path, "mixed.csv", text)
    df = R.read_mixed_csv(spark, path)
    assert df.columns == ["proto", "service", "dur", "label"]
    # the row with an infinite duration is dropped, but its protocol has a code; a blank is 'nan'
    assert rows(df, "dur", "proto", "service", "label") == [(1.0, 1, 1, 0), (2.0, 2, 2, 1), (4.0, 1, 0, 1)]


def test_codes_follow_binary_order_and_null_is_a_category(spark):
    df = spark.createDataFrame([("b",), ("B",), (None,), ("a",), ("z",)], "c string")
    codes = {r.value: r.code for r in C.category_codes(df, ["c"]).collect()}
    assert codes == {"B": 0, "a": 1, "b": 2, "nan": 3, "z": 4}


def test_cache_is_written_once(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    write(folder, "a.csv", "Flow Duration,Label\n1,BENIGN\n2,DDoS\n")
    cache = str(tmp_path / "cache")
    first = R.dataset_cache(spark, cache, str(folder))
    (folder / "a.csv").write_text("Flow Duration,Label\n9,BENIGN\n")
    again = R.dataset_cache(spark, cache, str(folder))
    assert rows(first, "flow_duration", "label") == rows(again, "flow_duration", "label") == [(1.0, 0), (2.0, 1)]
    with pytest.raises(FileNotFoundError):
        R.dataset_cache(spark, str(tmp_path / "other"), str(tmp_path / "none"))


def test_cache_holds_all_rows_whatever_the_sample(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    write(folder, "a.csv", "Flow Duration,Label\n" + "".join(f"{i},BENIGN\n" for i in range(50)))
    cache = str(tmp_path / "cache")
    assert R.sample_of_cache(R.dataset_cache(spark, cache, str(folder)), 10).count() == 10
    assert R.dataset_cache(spark, cache, str(folder)).count() == 50


def test_doubled_quotes_and_quoted_commas(spark, tmp_path):
    write(tmp_path, "a.csv", 'Flow Duration,Label\n4,"DoS, ""slow"""\n1,"a ""x"", b"\n2,BENIGN\n')
    df = R.read_flow_csv(spark, str(tmp_path / "a.csv"))
    assert rows(df, "flow_duration", "label_text") == [(1.0, 'a "x", b'), (2.0, "BENIGN"), (4.0, 'DoS, "slow"')]


def test_a_folder_without_labels_is_refused(spark, tmp_path):
    write(tmp_path, "a.csv", "Flow Duration,Kind\n1,BENIGN\n")
    with pytest.raises(ValueError, match="no label"):
        R.read_flow_csv_dir(spark, str(tmp_path))


def test_missing_features_are_reported(spark):
    df = spark.createDataFrame([("1", "BENIGN")], "`Flow Duration` string, label string")
    kept, missing = C.project_canonical(C.resolve_label_column(df))
    assert kept.columns == ["Flow Duration", "Label"] and len(missing) == len(S.CANONICAL_FEATURES) - 1
    with pytest.raises(ValueError):
        C.resolve_label_column(spark.range(1))


def test_line_breaks_in_quotes_across_splits(spark, tmp_path):
    """Records over several lines, cut by splits of a few bytes, also inside a record longer than a split."""
    rng = random.Random(3)
    want, lines = [], ["Flow Duration,Note,Label"]
    for i in range(300):
        note = "".join(rng.choice(["a", ",", '"', "\n", "\n\n", " ", "é", "x" * 40]) for _ in range(rng.randint(0, 12)))
        note = rng.choice([note, "y" * 700 + "\n" + note, "plain", 'in"ner', "é\n" * 60])
        odd = any(x in note for x in ',"\n') and note != 'in"ner'
        quoted = '"' + note.replace('"', '""') + '"' if odd else note
        label = rng.choice(["BENIGN", "DDoS", '"a\nb"'])
        lines.append(f"{i},{quoted},{label}")
        want.append((float(i), int(label != "BENIGN")))
    write(tmp_path, "a.csv", "\n".join(lines) + "\n")
    write(tmp_path, "b.csv", "Flow Duration,Note,Label\n1000,plain,BENIGN\n\n1001,x,Bot\n")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        for size in (before, "400", "90"):
            spark.conf.set(name, size)
            got = rows(R.read_flow_csv_dir(spark, str(tmp_path)), "flow_duration", "label")
            assert sorted(got) == sorted([*want, (1000.0, 0), (1001.0, 1)]), size
        assert len(R._broken(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])) == 1
    finally:
        spark.conf.set(name, before)


def test_a_quote_opens_a_field_at_its_start_only():
    ends = R._line_ends()
    cases = [(b'a,"b', False, True), (b'a,b"c,d', False, False), (b'"a""b"', False, False), (b'x""y', True, True),
             (b'x",y,"z', True, True), (b'x",y"z', True, False), (b'"a""', False, True), (b'",', True, False)]
    assert [ends(line, inside) for line, inside, _ in cases] == [end for *_, end in cases]
