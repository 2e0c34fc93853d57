import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake.operators.embed import embed, embed_balanced, embed_in_batches, fuse_text, hashing_encoder
from paperlake.operators.enrich import enrich, enrich_in_batches, fill_missing
from paperlake.operators.responses import recover_fields

GOOD = '{"core_method": "m", "dataset_used": "d", "key_findings": "k"}'
NS, ERR = "Not specified", "Extraction Error"


@pytest.mark.parametrize(
    "response, how, values",
    [
        (GOOD, "json", ("m", "d", "k")),
        (f"```json\n{GOOD}\n```", "json", ("m", "d", "k")),
        (f"Here you are: {GOOD}", "json", ("m", "d", "k")),
        ('{ , "core_method": "m"}', "json", ("m", NS, NS)),
        ('{"core_method": "m", "dataset_used": null, "key_findings": true}', "json", ("m", NS, "true")),
        ('{"core_method": "m", "dataset_used": "d", "key_findings": "cut in the', "text", ("m", "d", "cut in the")),
        ('"core_method" : "m" , "key_findings": "k"}', "text", ("m", NS, "k")),
        # A closing quote at the very end is taken for part of a value that was cut short.
        ('"core_method" : "m" , "key_findings": "k"', "text", ("m", NS, 'k"')),
        (f"{GOOD} and }} more", "text", ("m", "d", "k")),
        ('{"core_method": "", "dataset_used": "d"', "text", ("", 'd"', NS)),
        ("{}", "json", (NS, NS, NS)),
        ('["a"]', "none", (ERR, ERR, ERR)),
        ("I cannot help", "none", (ERR, ERR, ERR)),
        (None, "none", (ERR, ERR, ERR)),
    ],
)
def test_recovery(spark, response, how, values):
    row = recover_fields(spark.createDataFrame([(response,)], "r string"), "r").first()
    assert (row.recovered, row.core_method, row.dataset_used, row.key_findings) == (how, *values)


def test_cue_phrases(spark):
    text = "We propose sparse nets. They are evaluated on MNIST, and we show that depth helps."
    record = enrich(spark.createDataFrame([(text,)], "abstract string")).first().metadata_json
    assert json.loads(record) == {"core_method": "sparse nets", "dataset_used": "MNIST", "key_findings": "depth helps"}


def test_one_bad_text_does_not_spoil_its_batch(spark):
    def flaky_extractor():
        def extract(texts):
            if any("poison" in t for t in texts):
                raise RuntimeError("cannot read this batch")
            return [json.dumps({"core_method": t.upper()}) if t != "mute" else None for t in texts]

        return extract

    rows = [(0, "one"), (1, "poison"), (2, "mute"), (3, " \n "), (4, None), (5, "two")]
    frame = spark.createDataFrame(rows, "id long, abstract string").coalesce(1)
    result = enrich(frame, extractor=flaky_extractor)
    assert result.columns == ["id", "abstract", "metadata_json"]
    method = {r.id: json.loads(r.metadata_json)["core_method"] for r in result.collect()}
    assert method == {0: "ONE", 1: ERR, 2: ERR, 3: NS, 4: NS, 5: "TWO"}


def test_default_fill(spark):
    frame = spark.createDataFrame([(None,), ("{}",)], "metadata_json string")
    values = [r[0] for r in fill_missing(frame).collect()]
    assert json.loads(values[0]) == dict.fromkeys(("core_method", "dataset_used", "key_findings"), NS) and values[1] == "{}"


def test_fused_text_skips_nulls_and_keeps_placeholders(spark):
    rows = [("t", None, f'{{"core_method":"{NS}","key_findings":null}}'), ("t", "a", None)]
    fused = fuse_text(spark.createDataFrame(rows, "title string, abstract string, metadata_json string"))
    assert [r.embedding_text for r in fused.collect()] == [f"t. {NS}", "t. a"]


def test_vectors_have_norm_one_and_ignore_case(spark):
    frame = spark.createDataFrame([(0, "Deep deep nets"), (1, "DEEP nets deep!"), (2, "é9 ß"), (3, None)], "id long, t string")
    for embedded in (embed(frame, "t", dim=32), embed_in_batches(frame, "t", dim=32, batch_rows=2)):
        v = {r.id: np.array(r.embedding) for r in embedded.collect()}
        assert all(len(x) == 32 for x in v.values())
        assert np.linalg.norm(v[0]) == pytest.approx(1, abs=1e-6) and np.linalg.norm(v[2]) == pytest.approx(1, abs=1e-6)
        assert (v[0] == v[1]).all() and not v[3].any()


def test_encoder_is_built_once_per_task_and_given_batches(spark):
    def build():
        calls = []

        def encode(texts):
            calls.append(len(texts))
            return np.array([[len(calls), len(texts)] for _ in texts], dtype=float)

        return encode

    frame = spark.range(10).select(F.col("id").cast("string").alias("t")).coalesce(1)
    rows = embed_in_batches(frame, "t", encoder=build, batch_rows=4).collect()
    ratios = [round(r.embedding[0] / r.embedding[1], 3) for r in rows]
    assert ratios == [0.25] * 4 + [0.5] * 4 + [1.5] * 2


def test_encoder_runs_once_per_row_even_when_its_result_is_exploded(spark, plan):
    frame = spark.createDataFrame([("a b",)], "t string")
    parts = embed(frame, "t", dim=4).select(F.explode("embedding"))
    assert plan(parts).split("== Physical Plan ==")[1].count("ArrowEvalPython") == 1


def test_the_extractor_gets_batches_of_the_size_asked_for(spark):
    def extractor():
        return lambda texts: [f'{{"core_method": "{len(texts)}"}}' for _ in texts]

    texts = spark.range(130).coalesce(1).selectExpr("concat('text ', id) AS abstract")
    found = enrich_in_batches(texts, extractor, batch_rows=50).selectExpr("get_json_object(metadata_json, '$.core_method') AS n")
    assert sorted((r.n, r["count"]) for r in found.groupBy("n").count().collect()) == [("30", 30), ("50", 100)]


def test_batches_of_like_length_and_equal_texts_once(spark, tmp_path):
    pick = random.Random(2)
    texts = [" ".join(pick.choices("abcdefg", k=pick.choice([1, 5, 50, 900]))) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[0]) for i in range(300)] + [(2000, None), (2001, ""), (2002, "x" * 10_000)]
    frame = spark.createDataFrame(rows, "id long, text string").repartition(5)
    log = tmp_path / "log"

    def encoder():
        encode = hashing_encoder(16)()

        def run(batch):
            with log.open("a") as out:
                out.write(f"{len(batch)} {sum(len(t.encode()) for t in batch)} {min(map(len, batch))} {max(map(len, batch))}\n")
            return encode(batch)

        return run

    made = embed_balanced(frame, "text", encoder, 16, batch_bytes=4000, tasks=3)
    expected = {r.id: r.embedding for r in embed(frame, "text", dim=16).collect()}
    assert {r.id: r.embedding for r in made.collect()} == expected and made.count() == len(rows)
    batches = [tuple(map(int, line.split())) for line in log.read_text().splitlines()]
    assert sum(n for n, *_ in batches) == len({t or "" for _, t in rows})
    assert all(size <= 4000 or n == 1 for n, size, _, _ in batches)
    full = sorted(size for n, size, _, longest in batches if longest > 500 and n > 1)
    assert full[len(full) // 2] >= 1700  # filled as far as the texts allow
    spread = [longest - shortest for n, _, shortest, longest in batches if n > 1]
    assert sorted(spread)[len(spread) // 2] <= 100  # a batch holds texts of like length
