"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib

import pytest
from edge_rows import CLASHING, EDGE, LONG, edge, none  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, html_extract, language_id, line_dedup, lm_score, mixing, ngram_join, secret_scan, substring_dedup, topk_search


def by_row(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_line_dedup(edge, none):
    got = line_dedup.dedup_lines(edge, min_docs=2, keep_first=False)
    assert got.columns == [*[c for c in edge.columns if c != "n_lines"], "n_lines", "n_dropped"]
    assert got.select("key").distinct().collect() == [("kept-key",)]
    found = by_row(got, "doc_id", "text", "n_lines", "n_dropped")
    assert len(found) == len(EDGE)
    assert (2, "", 1, 0) in found and (3, "", 1, 0) in found and (4, " \t\n\n \r", 3, 0) in found
    assert found.count((1, "", 2, 2)) == 2  # a repeated row counts as a row: all its lines repeat
    assert (6, "", 1, 1) in found and (7, "", 1, 1) in found
    first = by_row(line_dedup.dedup_lines(edge, min_docs=2), "doc_id", "text")
    assert (6, LONG) in first and (7, "") in first
    assert line_dedup.dedup_lines(none).count() == 0


def test_language(edge, none):
    network = language_id.fit_network(edge, steps=3)
    assert network.labels == ["de", "en", "es", "fr"][: len(network.labels)] or set(network.labels) <= {"de", "en", "es", "fr"}
    got = language_id.identify_language(edge, network)
    assert got.columns == [*[c for c in edge.columns if c not in ("lang_pred", "score")], "lang_pred", "score"]
    rows = got.select("text", "lang_pred", "score").collect()
    assert len(rows) == len(EDGE)
    for text, lang, score in rows:
        letters = text is not None and any(c.isalpha() for c in text)
        assert (lang == "und", score == 0.0) == (not letters, not letters)
        assert 0 <= score <= 1
    assert language_id.fit_network(none) is None
    assert {r[0] for r in language_id.identify_language(edge, None).select("lang_pred").collect()} == {"und"}
    assert language_id.identify_language(none, network).count() == 0


def test_ngram_join(edge, none):
    got = by_row(ngram_join.ngram_components(edge, 4, 85), "doc_id", "n_shingles", "component_id")
    assert len(got) == len(EDGE)
    assert got.count((1, 4, 1)) == 2 and (1, 3, 1) in got
    assert (2, 0, 2) in got and (3, 0, 3) in got and (4, 0, 4) in got and (9, 1, 9) in got
    long = [r for r in got if r[0] in (6, 7)]
    assert long[0][1:] == long[1][1:] and long[0][2] == 6
    assert (None, 0, None) in got
    kept = ngram_join.drop_near_duplicates(edge, 4, 85)
    assert kept.columns == edge.columns
    assert sorted((r[0] for r in kept.select("doc_id").collect()), key=repr) == sorted([1, 1, 2, 3, 4, None, None, 5, 6, 8, 9], key=repr)
    assert ngram_join.ngram_components(none).count() == 0 and ngram_join.drop_near_duplicates(none).count() == 0


def test_decontamination(spark, edge, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (None, LONG[:200]), (4, LONG[:120])], "item_id long, text string")
    got = decontaminate.mark_leaks(edge, items)
    assert got.columns == ["doc_id", "contaminated", "items", "n_windows"] and got.count() == len(EDGE)
    assert {r[0] for r in got.where("contaminated").select("doc_id").collect()} == {6, 7}
    assert decontaminate.drop_leaks(edge, items).columns == edge.columns
    assert decontaminate.drop_leaks(edge, items).count() == len(EDGE) - 2
    assert decontaminate.mark_leaks(none, items).count() == 0
    assert decontaminate.mark_leaks(edge, items.limit(0)).where("contaminated").count() == 0


def test_mixing(edge, none):
    got = by_row(mixing.mix_sources(edge), "doc_id", "size", "source_size", "taken")
    assert len(got) == len(EDGE) and all(t <= 3 * s for _, s, _, t in got)
    assert (2, 0, got[0][2], 0) in got or any(r[0] == 2 and r[1] == 0 and r[3] == 0 for r in got)
    kept = mixing.mix_sources(edge, keep=edge.columns)
    assert kept.columns == [*[c for c in edge.columns if c not in mixing.NEW], *mixing.NEW] and kept.count() == len(EDGE)
    assert mixing.mix_sources(none).count() == 0
    assert mixing.mix_sources(edge.where("doc_id in (2, 3, 4)")).agg(F.sum("taken")).first()[0] == 0


def test_secrets(edge, none):
    got = secret_scan.scan_secrets(edge)
    assert got.columns == ["doc_id", "base", "linked"] and got.count() == len(EDGE)
    assert got.where(F.size("base") > 0).count() == 0
    assert got.where(F.size("linked") > 0).count() == 0
    assert secret_scan.scan_secrets(none).count() == 0


def test_passages(edge, none):
    got = substring_dedup.repeated_passages(edge)
    assert got.columns == ["doc_id", "start_word", "end_word", "match_doc_id"]
    assert {(r[0], r[3]) for r in got.collect()} == {(6, 7), (7, 6)}
    assert [r[2] for r in got.collect()] == [80_000, 80_000]
    assert substring_dedup.repeated_passages(none).count() == 0


def test_scores(edge, none):
    model = lm_score.fit_lm(edge, rounds=1)
    got = lm_score.score_texts(edge, model)
    assert got.count() == len(EDGE)
    for text, n, total, mean in got.select("text", "n_tokens", "log_prob", "mean_log_prob").collect():
        assert n == len((text or "").split())
        assert (mean is None) == (n == 0) and total <= 0
    assert lm_score.score_texts(none, lm_score.fit_lm(none)).count() == 0


def test_pages(spark):
    deep = "<div>" * 3000 + "text" + "</div>" * 3000
    pages = [(1, "u", None), (1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", "plain words, no tags. None at all."), (None, "u", "<!-- open <p>x"), (5, "u", "<article><p>" + "Long, long. " * 50_000), (6, "u", deep), (7, "u", "<p title='open")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"text": F.lit("clash"), "path": F.lit("kept")})
    got = html_extract.extract_main_text(df)
    assert got.columns == ["page_id", "url", "text", "path"]
    text = {r[0]: r[2] for r in got.collect()}
    assert text[1] == text[2] == text[3] == text[None] == text[7] == ""
    assert text[4] == "plain words, no tags. None at all."
    assert text[5] == ("Long, long. " * 50_000).strip()
    assert got.count() == len(pages) and html_extract.extract_main_text(df.limit(0)).count() == 0


def test_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.5]), (50, [0.5, 1.0]), (50, [0.5, 1.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [1.0, None]), (5, [inf, 1.0]), (6, [nan, 1.0]), (7, [1.0]), (8, []), (None, [9.0, 9.0]), (100, [1.0]), (1, [1.0, 0.5]), (150, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "dim", "score", "rank")})
    got = topk_search.top_k(df, df.where("vec_id % 50 = 0"), k=3).collect()
    of = {}
    for q, rank, vec, score in sorted(got):
        of.setdefault(q, []).append((rank, vec, score))
    whole = 256 * 256 + 128 * 128
    assert of == {
        0: [(1, 1, whole), (2, 1, whole), (3, 2, whole)], 50: [(1, 0, 256 * 256), (2, 1, 256 * 256), (3, 1, 256 * 256)], 100: [(1, 7, 256 * 256)],
    }
    assert topk_search.top_k(df.limit(0), df.limit(0)).count() == 0 and topk_search.top_k(df, df.limit(0)).count() == 0
    assert topk_search.top_k(df.limit(0), df).count() == 0


@pytest.mark.parametrize("text,key", [(b" \tHeLLo \x0b", b"hello"), ("  É É ".encode(), "É É".encode()), (b"", b"")])
def test_line_key(text, key):
    assert line_dedup.line_key(text) == key


def test_clashing_names_are_there(edge):
    assert set(CLASHING) <= set(edge.columns) and hashlib.sha256(LONG.encode()).hexdigest()
