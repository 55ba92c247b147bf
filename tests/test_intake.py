import json

import pytest
from pyspark.sql import functions as F

from seedloom.operators import intake
from seedloom.sources import reports, sinks
from seedloom.sources import seed as seeds


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def run(spark, path, **options):
    raw = seeds.read_seed(spark, path)
    keys = intake.discover_columns(raw, in_file_order=True)
    checked = intake.map_and_validate(raw, *keys, **options)
    return keys, checked, intake.intake_metadata(checked).first()


def test_csv_with_fuzzy_headers(spark, tmp_path):
    path = write(
        tmp_path / "rows.csv",
        "Document Content , Doc_Class,Extra_Info\nValid CSV text,Category A,Note 1\nValid CSV text 2,Category B,\n"
        "Missing label text,,Note 2\n,Category A,Note 3\nValid CSV text 3,Category A,\n",
    )
    keys, checked, report = run(spark, path)
    assert keys == ("document_content", "doc_class")
    assert (report.total_raw_rows, report.total_valid_rows, report.total_dropped_rows) == (5, 3, 2)
    assert report.label_distribution == {"Category A": 2, "Category B": 1}
    assert [row.extra for row in intake.valid_rows(checked).orderBy("row_idx").collect()] == [
        {"extra_info": "Note 1"},
        {"extra_info": ""},
        {"extra_info": ""},
    ]


def test_json_array(spark, tmp_path):
    rows = [
        {"input": "Valid JSON text 1", "target": "Category B"},
        {"input": "Valid JSON text 2", "target": "Category A"},
        {"input": "Missing target"},
        {"target": "Category B"},
    ]
    keys, _, report = run(spark, write(tmp_path / "rows.json", json.dumps(rows)))
    assert keys == ("input", "target")
    assert (report.total_raw_rows, report.total_valid_rows, report.total_dropped_rows) == (4, 2, 2)
    assert report.label_distribution == {"Category A": 1, "Category B": 1}


def test_json_lines(spark, tmp_path):
    lines = [
        {"review": "Good product", "tag": "Positive"},
        {"review": "Bad product", "tag": "Negative"},
        {"review": "Empty tag", "tag": "   "},
    ]
    path = write(tmp_path / "rows.jsonl", "\n\n".join(map(json.dumps, lines)) + "\n")
    keys, checked, report = run(spark, path)
    assert keys == ("review", "tag")
    assert (report.total_raw_rows, report.total_valid_rows, report.total_dropped_rows) == (3, 2, 1)
    assert report.unique_labels == ["Negative", "Positive"]
    assert [row.reject_reason for row in intake.quarantined_rows(checked).collect()] == ["missing_label"]


def test_thai_seed_round_trip(spark, tmp_path):
    rows = [{"text": "นี่คือข้อตกลง", "label": "NDA"}, {"text": "สัญญาจ้างฉบับนี้", "label": "Employment"}]
    path = write(tmp_path / "seed.json", json.dumps(rows, ensure_ascii=False))
    _, checked, report = run(spark, path)
    assert report.label_distribution == {"Employment": 1, "NDA": 1}
    out = str(tmp_path / "out.jsonl")
    sinks.write_jsonl(intake.valid_rows(checked).select("text", "label"), out)
    lines = [row.value for row in spark.read.text(out).collect()]
    assert sorted(lines) == sorted(json.dumps(row, ensure_ascii=False, separators=(",", ":")) for row in rows)


def test_csv_shapes(spark, tmp_path):
    path = write(
        tmp_path / "rows.csv",
        'text,label,note\n"a ""quoted""\nline",x,"1,2"\nshort\nb,y,z,w\nc,y,,\n,x,n\n\nd,x,\n',
    )
    _, checked, report = run(spark, path)
    reasons = {row.row_idx: row.reject_reason for row in checked.collect()}
    assert list(reasons.values()) == [None, "missing_label", "surplus_fields", "surplus_fields", "missing_text", None]
    assert report.total_valid_rows == 2
    first = checked.orderBy("row_idx").first()
    assert first.text == 'a "quoted"\nline' and first.extra == {"note": "1,2"}
    _, checked, report = run(spark, path, null_as_literal=True)
    assert report.label_distribution["None"] == 1


def test_duplicate_and_blank_headers(spark, tmp_path):
    path = write(tmp_path / "rows.csv", "text,,text,label\nfirst,x,last,y\n")
    _, checked, _ = run(spark, path)
    row = checked.first()
    assert (row.text, row.label, row.extra) == ("last", "y", {"col_1": "x"})


def test_json_value_kinds(spark, tmp_path):
    content = '[{"text": true, "label": 1.50}, {"text": null, "label": "x"}, 3, "s", {"text": "a", "text": "b", "label": "l"}]'
    path = write(tmp_path / "rows.json", content)
    _, checked, report = run(spark, path)
    rows = checked.orderBy("row_idx").collect()
    assert [(r.text, r.label) for r in rows if r.reject_reason is None] == [("True", "1.5"), ("b", "l")]
    assert [r.reject_reason for r in rows] == [None, "missing_text", "not_object", "not_object", None]
    _, checked, _ = run(spark, path, null_as_literal=True)
    assert "None" in [r.text for r in checked.collect()]


def test_lone_object_is_one_row(spark, tmp_path):
    _, _, report = run(spark, write(tmp_path / "rows.json", '{"text": "a", "label": "b"}'))
    assert report.total_raw_rows == 1 and report.total_valid_rows == 1


def test_malformed_lines(spark, tmp_path):
    path = write(tmp_path / "rows.jsonl", '{"text": "a", "label": "b"}\n{"text": oops\nnot json\n')
    with pytest.raises(Exception, match="malformed JSON row"):
        seeds.read_seed(spark, path).collect()
    raw = seeds.read_seed_jsonl(spark, path, mode="quarantine")
    reasons = [r.reject_reason for r in intake.map_and_validate(raw, "text", "label").collect()]
    assert reasons == [None, "malformed", "malformed"]
    with pytest.raises(ValueError):
        seeds.read_seed_jsonl(spark, path, mode="ignore")


def test_dispatch_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        seeds.read_seed(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError):
        seeds.read_seed(spark, write(tmp_path / "rows.txt", "x"))
    assert seeds.read_rows(spark, str(tmp_path / "none.jsonl")).isEmpty()
    assert reports.read_label_list(spark, str(tmp_path / "none.json")) == []
    assert reports.read_label_list(spark, write(tmp_path / "bad.json", "{oops")) == []
    assert reports.read_label_list(spark, write(tmp_path / "good.json", '{"labels": ["b", "a"]}')) == ["b", "a"]


@pytest.mark.parametrize(
    "keys, expected",
    [
        (["id", "Text ", "LABEL"], ("Text ", "LABEL")),
        (["document_class"], ("document_class", "document_class")),
        (["percentage", "body"], ("body", "percentage")),
        (["my_text", "content", "category"], ("content", "category")),
        (["body"], ("text", "label")),
        ([], ("text", "label")),
    ],
)
def test_map_columns(keys, expected):
    assert intake.map_columns(keys) == expected


def test_normalize_headers():
    assert seeds.normalize_headers([" Doc Type ", "", None, "  "]) == ["doc_type", "col_1", "col_2", ""]


def test_empty_input(spark, tmp_path):
    _, _, report = run(spark, write(tmp_path / "rows.json", "[]"))
    assert (report.total_raw_rows, report.unique_labels, report.label_distribution) == (0, [], {})


def test_gate_and_conflicts(spark):
    rows = [(1, {"text": "a", "label": "x"}, True), (2, {"text": "a", "label": "y"}, True), (3, {"text": "b", "label": "x"}, True)]
    raw = spark.createDataFrame(rows, "row_idx bigint, raw map<string,string>, is_object boolean")
    checked = intake.map_and_validate(raw, "text", "label")
    gate = intake.intake_gate(checked).first()
    assert (gate.n_labels, gate.n_conflicts, gate.passed) == (2, 1, False)
    clean = checked.filter(F.col("row_idx") != 2).unionByName(
        intake.map_and_validate(raw.filter("row_idx = 2").withColumn("raw", F.create_map(F.lit("text"), F.lit("c"), F.lit("label"), F.lit("y"))), "text", "label")
    )
    assert intake.intake_gate(clean).first().passed
    assert not intake.intake_gate(clean, unknown_ratio=0.4).first().unknown_ratio_ok
    assert not intake.intake_gate(clean, include_unknown=False, unknown_ratio=0.1).first().unknown_ratio_ok
    assert intake.intake_gate(clean, include_unknown=False, unknown_ratio=0.0).first().passed


def test_label_limit(spark):
    rows = spark.range(20).select(F.col("id").cast("string").alias("label"))
    with pytest.raises(ValueError):
        intake.label_list(rows, limit=10)
