"""Pairs of long texts in the shingle join: what its filters leave, and what its check of whole sets writes."""

from tidemark.llm import ngram_join


def long_texts():
    """Texts of 1,500 words that have but one line in common, and an edited copy of the first."""
    line = [f"line{i}" for i in range(6)]
    texts = [[*(f"w{k}-{i}" for i in range(700)), *line, *(f"v{k}-{i}" for i in range(794))] for k in range(12)]
    texts.append([*texts[0][:1480], *(f"x{i}" for i in range(20))])
    return [(k, " ".join(words)) for k, words in enumerate(texts)]


def test_long_texts_with_a_line_in_common_are_no_pairs(spark):
    join = ngram_join._Join(spark.createDataFrame(long_texts(), "doc_id long, text string"), 4, 85, "doc_id", "text")
    one, other = join.rows, join.rows
    met = one.selectExpr("sig AS a", "n AS a_n").crossJoin(other.selectExpr("sig AS b", "n AS b_n")).where("a < b").selectExpr("*", "0 AS a_pos", "0 AS b_pos")
    (pair,) = join.filtered(met).collect()  # all 78 pairs meet; of those only the edited copy can be one
    assert {pair.a, pair.b} == {r.sig for r in join.rows.where("_nj_id IN (0, 12)").collect()}


def test_whole_sets_are_not_staged_and_links_are_whole(spark, monkeypatch):
    names, write = [], ngram_join.Scratch.write
    monkeypatch.setattr(ngram_join.Scratch, "write", lambda self, df, name: names.append(name) or write(self, df, name))
    docs = spark.createDataFrame(long_texts() * 2, "doc_id long, text string").repartition(5)
    got = {tuple(r) for r in ngram_join.ngram_components(docs, 4, 85).collect()}
    assert got == {(k, 1497, 0 if k == 12 else k) for k in range(13)}
    assert "star-links" in names and not [x for x in names if x.endswith("-sets")]
