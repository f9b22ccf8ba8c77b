"""Texts with very many hits."""

import re

from tidemark.llm import secret_scan


def test_many_secrets_in_one_text(spark):
    """The work of a text is in proportion to its hits; every position is right to the last one."""
    parts = [f'password={"abc123XYZ0%06d" % i} user_name=bob{i} https://h{i}.example.com/x 0123456789abcdef{i:06d} é' for i in range(12_500)]
    text = " ".join(parts)
    row = secret_scan.scan_secrets(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).where("doc_id = 1").first()
    want = [(m.start(), "assign", m.end()) for m in re.finditer(r"password=[A-Za-z0-9]+", text)] + [(m.start(), "hex", m.end()) for m in re.finditer(r"0123456789abcdef\d+", text)]
    assert [(s["start"], s["kind"], s["end"]) for s in row["base"]] == sorted(want)
    weak = [(m.start(), "identifier", m.end()) for m in re.finditer(r"user_name=bob\d+", text)] + [(m.start(), "endpoint", m.end()) for m in re.finditer(r"https://\S+", text)]
    assert [(s["start"], s["kind"], s["end"]) for s in row["linked"]] == sorted(weak)


def test_weak_parts_over_base_spans(spark):
    """What a base span covers is not listed again, however far the two reach."""
    key = "Ab1" * 200  # several stretches long
    texts = [f"token: {key} user=alice", f"x {key} AKIA{'Z' * 20} y", f"{key} login=bob"]
    got = secret_scan.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    told = [([s["kind"] for s in r["base"]], [s["kind"] for s in r["linked"]]) for r in got]
    assert told == [(["assign"], ["identifier"]), (["access"], ["material"]), ([], ["material", "identifier"])]
