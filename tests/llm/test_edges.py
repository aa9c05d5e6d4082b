"""Every operator and stage takes NULLs, empty and long texts, repeats, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clientele.llm.decontamination import find_copies, without_leaks
from clientele.llm.exact_dedup import exact_groups, without_copies
from clientele.llm.html import extract_text
from clientele.llm.jaccard import near_groups, one_of_each_group
from clientele.llm.language_model import held_out_fold, score_texts
from clientele.llm.licenses import license_scan
from clientele.llm.packing import pack_tokens
from clientele.llm.pieces import encode_pieces
from clientele.llm.quality import learn_quality, quality_scores
from clientele.llm.sharding import shuffle_into_shards

@pytest.fixture(scope="module")
def documents(spark):
    """Documents with the awkward rows: NULLs in every column, empty and long texts, repeats, odd columns."""
    def build(texts, extra=()):
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in enumerate(texts)] + list(extra)
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long")
    return build


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()


def prose(seed: int, n: int) -> str:
    import random
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(documents):
    """Every case that an operator must take without falling over."""
    long = prose(1, 20_000)
    texts = [prose(2, 60), None, "", " \n\t ", "one", prose(2, 60).upper(), long, long, "Ünïcödé ▁   \x00 end",
             prose(3, 60), prose(3, 60)]
    return documents(texts, [(None, prose(4, 30), None, None, None), (None, None, None, None, None),
                             (3, prose(3, 60), "de", None, 1), (3, prose(3, 60), "de", None, 1)])


CLASHING = ("row", "name", "score", "shard", "slot", "ids", "id", "word", "part", "set", "__id", "key_id", "text_read", "text_key", "group")


def _labels(spark, docs):
    return docs.where("doc_id IS NOT NULL").select(
        "doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic")).union(
        spark.createDataFrame([(None, 1, 0), (0, None, None), (99, 1, None)], "doc_id long, quality int, toxic int"))


def _benchmark(spark):
    return spark.createDataFrame([(0, None), (1, ""), (None, "one two three four"), (2, "a b"), (3, "alpha0 beta1 gamma2 xi3")],
                                 "item_id long, text string")


def _all(spark, docs):
    """Name and result of each operator, with the rows it must have (None: any)."""
    labels, benchmark = _labels(spark, docs), _benchmark(spark)
    n = docs.count()
    weights = learn_quality(docs, labels)
    yield "pack", pack_tokens(docs, width=64), None
    yield "licenses", license_scan(docs), 0
    yield "pieces", encode_pieces(docs), n
    yield "jaccard", near_groups(docs), n
    yield "jaccard stage", one_of_each_group(docs), None
    yield "lm", score_texts(docs, held_out_fold()), n
    yield "quality", quality_scores(docs, weights), n
    yield "exact", exact_groups(docs), n
    yield "exact stage", without_copies(docs), None
    yield "shards", shuffle_into_shards(docs, 3), n
    yield "html", extract_text(docs.withColumnRenamed("text", "html")), n
    yield "leaks", find_copies(docs, benchmark), None
    yield "leaks stage", without_leaks(docs, benchmark), None


def test_awkward_rows_and_clashing_columns(spark, awkward):
    docs = awkward
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit("x"))
    for name, result, rows in _all(spark, docs):
        found = result.collect()
        assert rows is None or len(found) == rows, name


def test_empty_tables(spark, awkward):
    for name, result, _ in _all(spark, awkward.limit(0)):
        assert result.collect() == [], name


def test_pipeline_stages_take_awkward_rows(spark, awkward, tmp_path):
    _labels(spark, awkward).write.parquet(str(tmp_path / "labels.parquet"))
    _benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    odd = awkward.withColumn("score", F.lit("mine")).withColumn("name", F.lit("mine"))
    for docs in (odd, odd.limit(0)):
        for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            kept = out.collect()
            if place < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns, name
            assert len(kept) <= docs.count(), name


@pytest.mark.parametrize("stage, same", [(without_copies, "lower(coalesce(text, ''))"),
                                         (one_of_each_group, "lower(coalesce(text, ''))")])
def test_one_row_of_each_group_stays(awkward, stage, same):
    kept = stage(awkward).selectExpr("*", f"{same} AS same")
    words = kept.where("text RLIKE '[^ \\\\n\\\\t]'")
    assert words.count() == words.select("same").distinct().count()
    assert set(r[0] for r in words.select("same").distinct().collect()) == set(
        r[0] for r in awkward.where("text RLIKE '[^ \\\\n\\\\t]'").selectExpr(same).distinct().collect())
