"""The corpus pipeline: each stage's decision against a brute-force version of it on the stage's own input."""

from collections import Counter

import corpus_pipeline
from test_documents import brute_classes, brute_removed, words

from tallyline.llm import suffixdedup


def test_stages_on_odd_and_planted_rows(spark, make_docs, odd_rows, prose, tmp_path):
    # brute force is quadratic in a text's length
    odd_rows = [r for r in odd_rows if r[0] not in (4, 5)]
    leak, shared = prose(20), prose(60)
    base = prose(200).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1 :]) for k in (3, 90)]
    planted = [
        (200, " ".join(base), "en", "a"), (201, near[0], "en", "a"), (202, near[1], "en", "b"), (203, " ".join(base), "en", "b"),
        (210, prose(30) + " " + leak + " " + prose(10), "en", "c"), (211, prose(40) + " " + shared + " " + prose(40), "en", "c"),
        (212, prose(50) + " " + shared + " " + prose(30), "en", "a"), (213, prose(80), "en", "b"),
    ]
    docs = make_docs([*odd_rows, *planted])
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "source_mixing":
            assert docs.columns == before.columns
        seen[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]

    letters = [(i, t) for i, t, *_ in [*odd_rows, *planted] if any(c.isalpha() for c in t or "")]
    assert Counter(seen["language_id"]) == Counter(letters)
    told = {i: t for i, t in seen["language_id"] if i is not None and i != 6}
    stays = {i for i, c in brute_classes(told).items() if i == c}
    assert Counter(i for i, _ in seen["near_dedup"] if i is not None and i != 6) == Counter(stays)
    assert {200, 210, 211, 212, 213} <= stays and not {201, 202, 203} & stays
    assert {i for i, _ in seen["suffix_dedup"]} == {i for i, _ in seen["near_dedup"]}
    before, after = dict(seen["near_dedup"]), dict(seen["suffix_dedup"])
    assert after[211] == before[211] and shared not in after[212] and len(after[212]) < len(before[212])
    lost = brute_removed(sorted((i, t.encode()) for i, t in before.items() if i is not None and i > 100))
    assert all(len(after[i].encode()) == n - removed for i, (n, removed, _, _) in lost.items())
    assert {i for i, _ in seen["suffix_dedup"]} - {i for i, _ in seen["decontamination"]} == {210}
    taken = {r["doc_id"]: r["taken"] for r in docs.collect()}
    assert set(taken) <= {i for i, _ in seen["decontamination"]} and all(taken.values())
    words_left = sum(len((t or "").split()) for _, t in seen["decontamination"])
    assert abs(sum(taken.values()) - words_left) <= 4


def test_run_on_a_small_table(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.count() > 0 and {"doc_id", "text", "taken"} <= set(got.columns)


def test_cut_texts_keep_whole_characters():
    assert suffixdedup.kept_bytes("aéb", [{"start": 2, "end": 4}]).decode("utf-8", "ignore") == "a"
    assert words("A-b") == ["a", "b"]
