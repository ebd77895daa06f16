import duckdb
import pytest
from pyspark.sql import functions as F

from postlake.llm import language, mixing, quality, toxicity
from postlake.llm.queries import ORACLES, QUERIES
from tests.llm.brute import repeated_words


@pytest.fixture(scope="module")
def db(sf_dir):
    from tools.check import connect

    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, sf_dir, name):
    from tools.check import sorted_rows

    result = QUERIES[name](spark, sf_dir)
    cursor = db.execute(ORACLES[name])
    want = sorted_rows([c[0] for c in cursor.description], cursor.fetchall())
    assert sorted_rows(result.columns, [tuple(row) for row in result.collect()]) == want


NO_PYTHON = ["op2_source_mixing", "op6_quality_rules", "op10_tool_calls"]


@pytest.mark.parametrize("name", NO_PYTHON)
def test_native_plans(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# Quality rules


def test_repeated_words(spark):
    texts = ["a b c a b c a b c", "a b c", "a b", "", None, "a a a a a", "x y z q x y z", "one two three four " * 30, "a b c d a b c"]
    frame = spark.createDataFrame([(t,) for t in texts], "text STRING")
    got = [row[0] for row in frame.select(quality.n_repeat_words(F.col("text")), quality.words_of(F.col("text"))).collect()]
    assert got == [repeated_words((t or "").split()) for t in texts]


def test_quality_of_awkward_documents(documents, clashing):
    docs = clashing(documents())
    judged = quality.judge(docs, features=("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    rows = judged.collect()
    assert len(rows) == docs.count()
    by_text = {row["text"]: row for row in rows}
    assert by_text[None]["n_words"] == by_text[""]["n_words"] == by_text[" \n\t "]["n_words"] == 0
    assert by_text[None]["rejected_by"] == "few_words"
    long = next(row for text, row in by_text.items() if text and len(text) > 100_000)
    assert (long["n_words"], long["n_repeat_words"], long["rejected_by"]) == (40_000, 40_000, "repeated_windows")
    assert quality.judge(documents([])).collect() == []


def test_order_changes_no_verdict(documents):
    good = " ".join(f"word{chr(97 + i % 26)}{i}".replace("0", "o") for i in range(80))
    rows = [(1, good, "en", "s", 0), (2, "short", "en", "s", 0), (3, good.upper(), "en", "s", 0), (4, " ".join(w + "###" for w in good.split()), "en", "s", 0), (5, "a b c " * 30, "en", "s", 0)]
    docs = documents(rows)
    for order in (quality.RULES, quality.RULES[::-1]):
        named = {row["doc_id"]: row["r"] for row in docs.select("doc_id", quality.first_rejection(F.col("text"), order).alias("r")).collect()}
        assert {doc for doc, rule in named.items() if rule is None} == {1}
    ordered = quality.in_best_order(docs)
    assert [rule.name for rule, _, _ in ordered] != [] and all(0 <= share <= 1 for _, _, share in ordered)


# Mixing


def test_fit_meets_the_targets(spark):
    cells = spark.createDataFrame(
        [(s, l, t, float(1 + i * j + k)) for i, s in enumerate("abc") for j, l in enumerate(["en", "de"]) for k, t in enumerate(["x", "y"])],
        "source STRING, lang STRING, topic STRING, weight DOUBLE",
    )
    wanted = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 0.4, "de": 0.6}, "topic": {"x": 0.7, "y": 0.3}}
    targets = {dim: spark.createDataFrame(list(shares.items()), "value STRING, share DOUBLE") for dim, shares in wanted.items()}
    fitted = mixing.fit(cells, targets, rounds=12)
    total = fitted.agg(F.sum(F.col("weight") * F.col("rate"))).first()[0]
    for dim, shares in wanted.items():
        got = {row[0]: row[1] / total for row in fitted.groupBy(dim).agg(F.sum(F.col("weight") * F.col("rate"))).collect()}
        assert got == pytest.approx(shares, abs=1e-5)
    kept = mixing.probabilities(fitted, 0.4)
    expected = kept.agg(F.sum(F.col("weight") * F.col("probability")) / F.sum("weight")).first()[0]
    assert expected == pytest.approx(0.4, abs=0.01)
    assert kept.agg(F.max("probability")).first()[0] <= 1.0


def test_fit_goes_on_until_the_targets_are_met(spark):
    # Source and language hang together, so that scaling one undoes the other for many rounds.
    cells = spark.createDataFrame(
        [(s, l, "x", 20.0 if s == l else 1.0) for s in "abc" for l in "abc"], "source STRING, lang STRING, topic STRING, weight DOUBLE",
    )
    wanted = {"source": [("a", 0.5), ("b", 0.3), ("c", 0.2)], "lang": [("a", 0.2), ("b", 0.3), ("c", 0.5)]}
    targets = {dim: spark.createDataFrame(shares, "value STRING, share DOUBLE") for dim, shares in wanted.items()}
    assert mixing.deviation(mixing.fit(cells, targets, rounds=3), targets) > 1e-4
    met = mixing.fit(cells, targets, tolerance=1e-9)
    assert mixing.deviation(met, targets) <= 1e-9
    shuffled = mixing.fit(cells, targets, tolerance=1e-9, rounds=6, one_task=0).collect()
    alone = {row[:3]: row["rate"] for row in mixing.fit(cells, targets, tolerance=1e-9, rounds=6).collect()}
    assert {row[:3]: row["rate"] for row in shuffled} == pytest.approx(alone, rel=1e-12)


def test_fit_of_targets_that_no_weights_meet(spark):
    cells = spark.createDataFrame([("a", "x", "", 1.0), ("b", "y", "", 2.0), ("c", "x", "", 3.0)], "source STRING, lang STRING, topic STRING, weight DOUBLE")
    wanted = {"source": [("a", 0.9), ("b", 0.1)], "lang": [("x", 0.5), ("y", 0.5), ("z", 1.0)]}
    targets = {dim: spark.createDataFrame(shares, "value STRING, share DOUBLE") for dim, shares in wanted.items()}
    fitted = mixing.fit(cells, targets, rounds=4)
    assert {row["source"] for row in fitted.where("rate > 0").collect()} == {"a", "b"}
    assert mixing.deviation(fitted, targets) > 0.1
    assert mixing.fit(cells.limit(0), targets).collect() == []
    assert all(row["rate"] == 1.0 for row in mixing.fit(cells, {}).collect())


def test_mixing_of_awkward_documents(documents, clashing):
    docs = clashing(documents())
    rows = mixing.mix(docs, prefix="_mix_").collect()
    assert len(rows) == docs.count()
    assert all(row["topic"] == "own" and 0 <= row["_mix_probability"] <= 1 for row in rows)
    assert len({row["_mix_kept"] for row in rows if row["doc_id"] == 1 and row["text"].startswith("The")}) == 1
    assert mixing.mix(documents([])).collect() == []


def test_draws_near_their_probabilities(spark):
    share = spark.range(20_000).select(F.avg((mixing.draw(F.col("id").cast("string"), "s") < 0.3).cast("double"))).first()[0]
    assert share == pytest.approx(0.3, abs=0.015)


# Toxicity


def test_toxicity_query(spark, sf_dir):
    larger = sf_dir.replace("sf0.001", "sf0.1")
    got = QUERIES["op5_toxicity"](spark, larger)
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    right = sum(row["predicted"] == row["toxic"] for row in rows) / len(rows)
    found = [row["predicted"] for row in rows if row["toxic"]]
    assert right > 0.96 and sum(found) / len(found) > 0.8
    assert got.count() == spark.read.parquet(f"{larger}/documents.parquet").count()
    assert got.where("score < 0 OR score > 1 OR (score >= 0.5) != (predicted = 1)").isEmpty()


def test_held_out_labels_teach_nothing(spark, documents):
    import zlib

    texts = ["awful scum here"] * 40 + ["nice day out"] * 60
    rows = [(i, text, "en", "s", 0) for i, text in enumerate(texts)]
    labels = [(i, 1, int(i < 40)) for i in range(100)]
    out = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0]
    turned = [(i, q, 1 - t if i in out else t) for i, q, t in labels]
    schema = "doc_id BIGINT, quality INT, toxic INT"
    one = toxicity.fit(documents(rows), spark.createDataFrame(labels, schema))
    other = toxicity.fit(documents(rows), spark.createDataFrame(turned, schema))
    assert one == other
    assert one.score("awful scum there") > 0.5 > one.score("a nice day")


def test_toxicity_of_awkward_documents(spark, documents, clashing):
    docs = clashing(documents())
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 1, None), (None, 0, 1), (99, 0, 0)], "doc_id BIGINT, quality INT, toxic INT")
    for known in (labels, labels.limit(0)):
        rows = toxicity.score(docs, toxicity.fit(docs, known)).collect()
        assert len(rows) == docs.count() and all(0 <= row["score"] <= 1 for row in rows)
    assert toxicity.score(documents([]), toxicity.fit(documents([]), labels)).collect() == []


# Language


def test_language_query(spark, sf_dir):
    got = QUERIES["op8_language_id"](spark, sf_dir).collect()
    declared = {row["doc_id"]: row["lang"] for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(got) == len(declared)
    assert sum(row["language"] == declared[row["doc_id"]] for row in got) >= 0.98 * len(got)
    assert all(row["kept"] for row in got)


def test_text_outweighs_a_wrong_declaration(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    wrong = docs.where("doc_id < 40 AND length(text) > 400").withColumn("doc_id", F.col("doc_id") + 10_000).withColumn(
        "lang", F.when(F.col("lang") == "en", "fr").otherwise("en")
    )
    truth = {row["doc_id"] + 10_000: row["lang"] for row in docs.collect()}
    found = language.identify(docs.unionByName(wrong)).where("doc_id >= 10000").collect()
    assert sum(row["language"] == truth[row["doc_id"]] for row in found) >= 0.9 * len(found) > 0


def test_host_priors_shrink_to_their_parents(spark):
    hosts = spark.createDataFrame([("www.a.de",), ("a.de",), ("shop",)], "h STRING")
    levels = language._levels(F.col("h"))
    assert [tuple(row) for row in hosts.select("h", levels["domain"], levels["suffix"]).collect()] == [
        ("www.a.de", "a.de", "de"), ("a.de", "a.de", "de"), ("shop", "shop", ""),
    ]


def test_page_evidence(spark):
    pages = spark.createDataFrame([
        (2, "https://WWW.x.example.de/de/17?p=1", '<!DOCTYPE html><html class="a" LANG=de-AT><p>'), (1, "http://y.example.fr/17", "<html lang='fr'>"),
        (3, "https://z.example.com/about", '<html lang="en">'), (4, "", None), (5, None, ""), (6, "http://n.example.com/99999999999999999999", "<html>"),
    ], "page_id BIGINT, url STRING, html STRING")
    assert [tuple(row) for row in language.page_evidence(pages).collect()] == [(17, "fr", "y.example.fr")]


def test_page_evidence_wherever_it_stands(spark):
    pages = spark.createDataFrame([
        (1, "http://a.example.de/1", f"<!-- {'x' * 5000} -->\n<HTML LANG='DE'>"), (2, "HTTP://B.example.es/es/2", '<html lang="es">'),
        (3, "http:///3", "<html>"), (4, "http://c.example.fr/3", None), (5, "http://d.example.com/3", "<html lang=fr>"),
        (None, "http://e.example.com/3", "<html lang=en>"), (None, "http://f.example.com/4", "<html lang=en>"),
    ], "page_id BIGINT, url STRING, html STRING")
    assert sorted(map(tuple, language.page_evidence(pages).collect())) == [
        (1, "de", "a.example.de"), (2, "es", "b.example.es"), (3, "fr", "c.example.fr"), (4, "en", "f.example.com"),
    ]


def test_language_of_awkward_documents(documents, clashing):
    docs = clashing(documents())
    rows = language.identify(docs).collect()
    assert len(rows) == docs.count()
    assert all(not row["kept"] and row["language"] is None for row in rows if row["doc_id"] in (2, 3, 4))
    assert any(row["kept"] for row in rows if row["doc_id"] is None)
    assert language.identify(documents([])).collect() == []
