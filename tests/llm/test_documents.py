"""Operators on documents against brute force, and their defined results on odd rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd
import pytest
from compare import duck, duck_rows, rows_of, spark_rows

from tallyline.llm import decontaminate, language, licenses, mixing, neardup, queries, suffixdedup
from tallyline.llm.words import counted_shingles, word_hashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute_similarity(a, b):
    both = set(a) & set(b)
    plain = len(both) / len(set(a) | set(b)) if both else 0.0
    every = set(a) | set(b)
    prob = sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in every) for i in both)
    return prob, plain


# ---- words -----------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "  ", "One TWO,one two", "ÉcoLE éCole 1-2_3", "a" * 50, "x{y}z~\x7f"])
def test_words_are_those_of_the_pattern(text):
    hashes, starts, ends = word_hashes(text.encode())
    found = words(text)
    assert [re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()[s:e]).decode() for s, e in zip(starts, ends)] == found
    assert len(set(hashes.tolist())) == len(set(found))


def test_long_words_and_texts_cross_blocks(monkeypatch):
    text = ("ab " * 7 + "w" * 40 + " c").encode()
    whole = word_hashes(text)
    monkeypatch.setattr("tallyline.llm.words._BLOCK", 16)
    assert all((x == y).all() for x, y in zip(whole, word_hashes(text)))


# ---- near duplicates -------------------------------------------------------------


def test_similarity_equals_brute_force(prose):
    base = prose(60)
    for other in (base, base + " more words here now", base.replace("stone", "iron"), "the of and " * 20, prose(30), base[: len(base) // 2] * 3):
        got = neardup.similarity(counted_shingles(base.encode(), 5), counted_shingles(other.encode(), 5))
        assert got == pytest.approx(brute_similarity(shingles(base), shingles(other)))


def test_signatures_estimate_probability_jaccard():
    a = np.arange(1, 61, dtype=np.uint64), np.r_[np.full(30, 5), np.full(30, 1)]
    b = np.arange(11, 71, dtype=np.uint64), np.r_[np.full(30, 4), np.full(30, 2)]
    sig = neardup.signatures([a, b], 4000)
    assert (sig[0] == sig[1]).mean() == pytest.approx(neardup.similarity(a, b)[0], abs=0.03)


def brute_classes(texts):
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    kinds = {i: shingles(t) for i, t in texts.items()}
    for i, j in combinations(texts, 2):
        if kinds[i] and kinds[j] and (texts[i] == texts[j] or max(brute_similarity(kinds[i], kinds[j])) >= 0.8):
            low, high = sorted((find(i), find(j)))
            parent[high] = low
    return {i: find(i) for i in texts}


@pytest.fixture(scope="module")
def copies(prose):
    texts = {}
    for g in range(6):
        base = prose(150).split()
        for k in range(5):
            changed = list(base)
            for at in range(0, g * k, 1):
                changed[(at * 29 + k) % 150] = f"new{k}{at}"
            texts[g * 10 + k] = " ".join(changed)
    return texts | {90: texts[0], 91: texts[0].upper(), 92: "one two three", 93: "one two three", 94: "one two four"}


@pytest.mark.parametrize("block", [1000, 2])
def test_classes_equal_brute_force(make_docs, copies, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "LARGE", block)
    monkeypatch.setattr(neardup, "NEIGHBOURS", 1)
    classes = neardup.near_duplicates(make_docs(copies.items()))[0]
    assert {r["doc_id"]: r["class_id"] for r in classes.collect()} == brute_classes(copies)


def with_repeated_line(prose, times):
    """Texts and copies of them whose last line stands often: plain similarity 0.98, probability Jaccard near 0.1."""
    bases = [prose(200) for _ in range(6)]
    return {2 * k + c: text + (" " + " ".join(text.split()[-10:])) * (times * c) for k, text in enumerate(bases) for c in (0, 1)}


@pytest.mark.parametrize("block", [1000, 1])
def test_copies_that_repeat_a_line_are_found(make_docs, prose, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = with_repeated_line(prose, 200)
    prob, plain = brute_similarity(*(shingles(texts[k]) for k in (0, 1)))
    assert prob < 0.2 and plain > 0.9
    classes = neardup.near_duplicates(make_docs(texts.items()))[0]
    assert {r["doc_id"]: r["class_id"] for r in classes.collect()} == brute_classes(texts) == {k: k - k % 2 for k in texts}


def test_second_pass_tells_pairs_alike_by_their_plain_signature(prose):
    texts = with_repeated_line(prose, 200)
    rows = pd.DataFrame({"id": [0, 1], "digest": ["", ""], "text": [texts[0], texts[1]]})
    sketch = next(neardup._sketch(25, 5, 5)(iter([rows])))
    keys = [np.resize(k, (2, 25)) for k in sketch["keys"]]
    band = int(np.flatnonzero((keys[0] == keys[1]).any(axis=0))[0])
    group = pd.DataFrame({"key": 1, "i": 0, "j": 0, "band": band, "node": [0, 1], "root": [0, 1], "block": 0, "sig": sketch["sig"], "short": None})
    found = pd.concat(neardup._across(25, 5, neardup.AGREE, 0.8)(iter([group])))
    assert found.values.tolist() == [[0, 1]]


def test_near_duplicates_of_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    classes = neardup.near_duplicates(docs)[0]
    got = Counter((r["doc_id"], r["class_id"]) for r in classes.collect())
    assert sum(got.values()) == len(odd_rows)
    assert got[(1, 1)] == 1 and got[(2, 2)] == 2 and got[(4, 4)] == 1 and got[(5, 4)] == 1 and got[(8, 8)] == 2 and got[(None, None)] == 4
    stay = neardup.one_of_each(docs)
    assert stay.columns == docs.columns
    assert Counter(r["doc_id"] for r in stay.collect()) == Counter([1, 2, 3, 4, 6, 7, 8, None, None])
    assert neardup.near_duplicates(docs.limit(0))[0].count() == 0 and neardup.one_of_each(docs.limit(0)).count() == 0


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(300, 299)]
    got = dict(neardup.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {i: got[i] for i in range(41)} == dict.fromkeys(range(41), 0)
    assert got[139] == 100 and got[300] == got[299] == 299 and len(got) == 41 + 40 + 2


def test_components_run_no_round_that_changes_nothing(spark, monkeypatch):
    rounds, put = [], neardup.written
    monkeypatch.setattr(neardup, "written", lambda df, name: rounds.append(name) or put(df, name))
    stars = [(9, 1), (1, 8), (8, 1), (1, 7), (30, 20), (30, 20), (5, 5)]
    got = neardup.components(spark.createDataFrame(stars, "a long, b long")).collect()
    assert sorted(got) == [(1, 1), (7, 1), (8, 1), (9, 1), (20, 20), (30, 20)]
    assert len(rounds) == 1
    rounds.clear()
    assert neardup.components(spark.createDataFrame([], "a long, b long")).count() == 0 and len(rounds) == 1


def counted_plans(module, monkeypatch):
    """Plans of the sides that a module counts before it broadcasts them."""
    plans, side = [], module.small_or_not
    monkeypatch.setattr(module, "small_or_not", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or side(df))
    return plans


def test_buckets_of_the_second_pass_are_not_made_again_to_be_counted(make_docs, copies, monkeypatch):
    plans = counted_plans(neardup, monkeypatch)
    neardup.near_duplicates(make_docs(copies.items()))
    assert len(plans) == 2 and not any("Join" in p for p in plans)


def test_anchors_are_not_made_again_to_be_counted(spark, make_docs, prose, monkeypatch):
    texts = {k: prose(40) for k in range(4)}
    benchmark = spark.createDataFrame([("a", texts[1]), ("b", prose(30))], "item_id string, text string")
    tokens = decontaminate.token_store(make_docs(texts.items()))
    windows = decontaminate.item_windows(benchmark)[1]
    windows = decontaminate.rarest_places(windows, decontaminate.term_counts(tokens, windows))
    plans = counted_plans(decontaminate, monkeypatch)
    found = decontaminate.phrase_matches(tokens, windows)
    assert {r["doc_id"] for r in found.collect()} == {1}
    # the terms of the anchors, and the anchors; the third are the candidates, written before
    assert len(plans) == 3 and not any("Join" in p for p in plans)


# ---- licences --------------------------------------------------------------------

LICENSED = {
    51: "Licensed under the Apache License, Version 2.0. And the apache license again",
    52: "released under THE MIT License",
    53: "cc by cc by-nc 4.0; Licensed under CC BY-NC 4.0.",
    54: "This work is licensed under the GNU General Public License, version 3.",
    55: "apache the license mit a license gnu public",
    56: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
}


def test_licences_equal_brute_force(make_docs, odd_rows):
    got = licenses.scan_licenses(make_docs([*LICENSED.items(), *odd_rows])).collect()
    assert len(got) == len(LICENSED) + len(odd_rows)
    texts = defaultdict(set)
    for r in (*LICENSED.items(), *odd_rows):
        texts[r[0]].add(r[1])
    for r in got:
        if len(texts[r["doc_id"]]) > 1:
            continue
        w = words(next(iter(texts[r["doc_id"]])))
        places = [(i, t.label) for t in licenses.BASE for i in range(len(w)) if w[i : i + len(t.text.split())] == t.text.split()]
        starts = [i for i, _ in places]
        want = len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({k for _, k in places}))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    label = {r["doc_id"]: r["labels"] for r in got if r["doc_id"] in LICENSED and r["n_words"] > 2}
    assert "apache-2.0" in label[51] and "mit-notice" in label[52] and "cc-by-nc-4.0" in label[53] and "gpl-3.0" in label[54]
    assert licenses.scan_licenses(make_docs(odd_rows).limit(0)).count() == 0


def brute_labels(w):
    """Labels of the notices whose key phrase stands and of whose words at most a fifth are missing, by trying every place."""
    found = set()
    for t in licenses.NOTICES:
        x, k = t.text.split(), t.keys[0].split()
        off = next(i for i in range(len(x)) if x[i : i + len(k)] == k)
        may = len(x) // 5
        shift = max(1, may)
        for start in (i - off for i in range(len(w)) if w[i : i + len(k)] == k):
            best = defaultdict(int)
            for i in range(len(x)):
                for j in range(max(0, start - shift), min(len(w), start + len(x) + shift)):
                    hit = best[i - 1, j - 1] + 1 if x[i] == w[j] and abs(j - start - i) <= shift else 0
                    best[i, j] = max(best[i - 1, j], best[i, j - 1], hit)
            if max(best.values()) >= len(x) - may:
                found.add(t.label)
    return found


def test_altered_notices_equal_brute_force():
    draw = np.random.default_rng(11)
    frequencies = {}
    index = licenses.Index(licenses.NOTICES, frequencies)
    hits = 0
    for t in licenses.NOTICES:
        x, key = t.text.split(), t.keys[0].split()
        off = next(i for i in range(len(x)) if x[i : i + len(key)] == key)
        free = [i for i in range(len(x)) if not off <= i < off + len(key)]
        for _ in range(60):
            w = list(x)
            for i in draw.choice(free, min(len(free), int(draw.integers(0, 6))), replace=False) if free else ():
                w[i] = "other"
            for _ in range(int(draw.integers(0, 4))):
                w.insert(int(draw.choice([*range(off + 1), *range(off + len(key), len(w) + 1)])), "extra")
            w = ["before"] * int(draw.integers(0, 3)) + w + ["after"] * int(draw.integers(0, 3))
            got = {index.templates[n].label for n, _, _ in index.places(word_hashes(" ".join(w).encode())[0])}
            assert got == brute_labels(w), w
            hits += bool(got)
    assert hits > 300


@pytest.mark.parametrize("changed", [(8, 12, 20), (10, 11, 13, 15)])
def test_notice_is_found_without_its_rarest_words(changed):
    t = next(t for t in licenses.NOTICES if t.label == "bsd")
    w = t.text.split()
    rare = {int(word_hashes(w[i].encode())[0][0]) for i in changed}
    frequencies = {int(h): int(int(h) not in rare) for h in word_hashes(t.text.encode())[0]}
    for i in changed:
        w[i] = f"new{i}"
    index = licenses.Index([t], frequencies)
    assert [s for _, s, _ in index.places(word_hashes(" ".join(w).encode())[0])] == [0]


def test_template_without_key_phrase_is_found_by_what_is_left():
    t = licenses.Template("x", "one two three four five six seven eight nine ten", ())
    index = licenses.Index([t], {})
    for gone in combinations(range(10), 2):
        w = ["new" if i in gone else x for i, x in enumerate(t.text.split())]
        assert 0 in {s for _, s, _ in index.places(word_hashes(" ".join(w).encode())[0])}


# ---- decontamination -------------------------------------------------------------


@pytest.fixture(scope="module")
def leaks(prose):
    item = {1: prose(35), 2: prose(12), 3: "alpha beta gamma", 10: prose(14), 4: "", 5: None, 6: "of", None: "null item words"}
    item[11] = item[10]
    docs = {
        1: prose(40) + " " + item[1] + " " + prose(5), 2: item[2].upper().replace(" ", ", "), 3: "x alpha, Beta; gamma alpha beta gamma",
        4: " ".join(item[1].split()[5:14]), 5: item[10] + " of " + item[10], 6: "alpha beta delta", 7: "", 8: None, 9: "some null item words",
        10: " ".join(item[1].split()[:9] + ["not"] + item[1].split()[10:]),
    }
    return docs, item


def test_decontamination_equals_brute_force(spark, make_docs, leaks, odd_rows):
    docs, item = leaks
    benchmark = spark.createDataFrame(list(item.items()), "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(make_docs(docs.items()), benchmark).collect()}
    for i, text in docs.items():
        w, hit, found = words(text), set(), set()
        for name, t in item.items():
            x = words(t)
            for k in range(max(1, len(x) - 9) if x else 0):
                window = x[k : k + 10]
                for at in range(len(w) - len(window) + 1):
                    if w[at : at + len(window)] == window:
                        hit |= set(range(at, at + len(window)))
                        found.add("" if name is None else str(name))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert tuple(got[i][c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == (len(w), len(hit), len(found), digest, bool(hit))
    odd = decontaminate.contamination(make_docs(odd_rows), benchmark)
    assert odd.count() == len(odd_rows) and odd.where("doc_id = 6").count() == 2
    assert decontaminate.contamination(make_docs(odd_rows).limit(0), benchmark).count() == 0
    assert decontaminate.contamination(make_docs(odd_rows), benchmark.limit(0)).where("contaminated").count() == 0
    kept = decontaminate.clean_documents(make_docs(docs.items()), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in docs if not got[i]["contaminated"]}


def test_proximity_matches_allow_for_inserted_words(spark, make_docs, leaks):
    docs, item = leaks
    benchmark = spark.createDataFrame([(10, "lone zebra under yellow moon")], "item_id long, text string")
    tokens = decontaminate.token_store(make_docs([(1, "the lone zebra stood under a yellow moon"), (2, "zebra"), (3, "lone zebra under yellow moon")]))
    windows = decontaminate.item_windows(benchmark)[1]
    windows = decontaminate.rarest_places(windows, decontaminate.term_counts(tokens, windows))
    near = {r["doc_id"]: r["shift"] for r in decontaminate.proximity_matches(tokens, windows, 3).collect()}
    assert set(near) == {1, 3} and near[3] == 0


# ---- repeated passages -----------------------------------------------------------


def brute_removed(rows):
    seen, out = set(), {}
    for i, data in rows:
        lost = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            if (text := data[k : k + 100]) in seen:
                lost[k : k + 100] = True
            seen.add(text)
        kept = np.frombuffer(data, np.uint8)[~lost].tobytes()
        runs = int((lost & ~np.r_[False, lost[:-1]]).sum()) if len(data) else 0
        out[i] = len(data), int(lost.sum()), runs, hashlib.sha256(kept).hexdigest()
    return out


@pytest.mark.parametrize("hot", [50_000, 1])
def test_removal_equals_brute_force(make_docs, prose, hot, monkeypatch):
    a, b = prose(60), prose(40)
    docs = {
        1: a, 2: b + a[50:300] + b, 3: a, 4: a[:120] + "é" + a[121:], 5: "ab" * 300, 6: b[:99], 7: b[:100], 8: b[:101], 9: prose(10) + a[10:200],
        10: "é" * 120, 11: "xé" + "é" * 130, 12: a + a, 13: None, 14: "",
    }
    monkeypatch.setattr(suffixdedup.with_runs, "__defaults__", (100, 40, hot))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixdedup.removal_report(make_docs(docs.items())).collect()}
    assert got == brute_removed([(i, (t or "").encode()) for i, t in docs.items()])


def test_removal_on_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = suffixdedup.removal_report(docs).collect()
    assert len(got) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5]["n_removed"] == by_id[4]["n_bytes"] and by_id[4]["n_removed"] == 0
    cut = suffixdedup.without_repeats(docs)
    assert cut.columns == docs.columns and {r["doc_id"]: r["text"] for r in cut.collect()}[5] == " end"
    assert suffixdedup.removal_report(docs.limit(0)).count() == 0


def test_anchors_cover_every_string_once_across_blocks(monkeypatch, prose):
    data = np.frombuffer(prose(400).encode(), np.uint8)
    monkeypatch.setattr(suffixdedup, "_BLOCK", 64)
    gram, place, far, near = suffixdedup.anchors(data)
    starts = np.sort(np.concatenate([np.arange(p - f, p - n + 1) for p, f, n in zip(place, far, near)]))
    assert (starts == np.arange(len(data) - 99)).all() and far.max() <= 60 and near.min() >= 0


def test_deep_shallow_order_sorts_within_groups():
    draw = np.random.default_rng(3)
    rows = draw.integers(0, 2, (300, 64)).astype(np.uint8)
    rows[:, :40] = rows[0, :40]
    rows[200:] = rows[:100]
    group = np.sort(draw.integers(0, 5, 300))
    order = suffixdedup.deep_shallow_order(group, rows)
    got = [(group[i], rows[i].tobytes()) for i in order]
    assert got == sorted(got) and sorted(order.tolist()) == list(range(300))


# ---- mixing ----------------------------------------------------------------------


def test_mix_meets_targets_and_equals_sql(spark, make_docs, odd_rows, prose):
    rows = [*odd_rows, *[(100 + i, prose(i % 17), None, "abcdefg"[i % 7 if i % 3 else 0]) for i in range(200)]]
    docs = make_docs(rows)
    mixed = mixing.mix_sources(docs)
    got = mixed.collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    by_target = defaultdict(int)
    for r in got:
        by_target[r["target"], r["source_size"]] += r["taken"]
    assert all(abs(t - taken) < 1 and t <= 3 * size for (t, size), taken in by_target.items())
    assert sum(t for t, _ in by_target) == pytest.approx(total)
    con = duckdb.connect()
    documents = docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})
    con.register("documents", documents)
    assert rows_of(mixed.columns, [tuple(r) for r in got]) == duck_rows(con, mixing.oracle())[1]
    assert mixing.mix_sources(docs.limit(0)).count() == 0


# ---- language --------------------------------------------------------------------


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert not any(r["rejected"] for r in got)


def test_language_of_odd_rows(make_docs, odd_rows):
    got = language.identify(make_docs(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 3))
    assert by_id[4]["lang_pred"] == "en" and 0 < by_id[4]["score"] <= 1
    none = language.identify(make_docs([(1, "text without language")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in none] == [("und", 0.0)]
    assert language.identify(make_docs(odd_rows).limit(0)).count() == 0


def test_all_grams_and_languages_are_learned(make_docs):
    draw = np.random.default_rng(2)
    many = "".join(map(chr, draw.integers(0x4E00, 0x9F00, 230_000)))
    words_of = ["".join(map(chr, draw.integers(97, 123, 40))) for _ in range(70)]
    rows = [(10 * k + j, text, f"l{k:02}") for k, text in enumerate([many, *words_of]) for j in range(1 if k == 0 else 6)]
    rows[0] = (next(i for i in range(9000, 9100) if zlib.crc32(str(i).encode()) % 5), many, "l00")
    model = language.train(make_docs(rows))
    assert len(model.languages) == 71 and np.isfinite(model.limits).all()
    want = {g for text in (many, *words_of) for g in language.grams(language.letter_codes(text)).tolist()}
    shards = [language._shard(model.path, k, model.discount.tobytes(), model.floor) for k in range(model.shards)]
    assert sum(len(x.grams.hashes) for x in shards) == len(want) > 200_000
    assert language.judge(model, [words_of[5]])[0] == ["l06"]


def brute_model(texts, letters):
    """Interpolated Kneser-Ney from dictionaries: probability of a gram of 1 to 4 codes."""
    counts = [None, Counter(), Counter(), Counter(), Counter()]
    for text in texts:
        codes = language.letter_codes(text).tolist()
        codes = [0] * max(0, 4 - len(codes)) + codes if codes else []
        counts[4].update(tuple(codes[i : i + 4]) for i in range(len(codes) - 3))
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def probability(gram):
        if not gram:
            return 1 / letters
        table = counts[len(gram)]
        ones, twos = sum(n == 1 for n in table.values()), sum(n == 2 for n in table.values())
        discount = ones / (ones + 2 * twos) if ones else 0.5
        same = [n for g, n in table.items() if g[:-1] == gram[:-1]]
        lower = probability(gram[1:])
        return (max(table[gram] - discount, 0) + discount * len(same) * lower) / sum(same) if same else lower

    return probability


@pytest.fixture(scope="module")
def small_model(spark):
    """Texts of two languages that are trained on as they are, and the model of them in one and in many shards."""
    texts = {"x": ["the cat sat on the mat", "that rat ate the hat; the cat sat", "a"], "y": ["le chat est sur la table", "la table est le chat \u00e9t\u00e9"]}
    docs = spark.createDataFrame([(k, t) for k, ts in texts.items() for t in ts], "lang string, text string")
    counts = language.gram_counts(docs).groupBy("lang", "gram").agg({"n": "sum"}).toDF("lang", "gram", "n")
    return texts, language.fit(counts), language.fit(counts, shard_bytes=300)


def test_cross_entropies_equal_brute_force(small_model):
    texts, model, cut = small_model
    assert model.shards == 1 and cut.shards > 5
    letters = 1 + len({c for ts in texts.values() for t in ts for c in language.letter_codes(t).tolist()})
    by_hand = {k: brute_model(ts, letters) for k, ts in texts.items()}
    asked = ["the cat", "le chat est sur la mat", "zzz q", "a", "t\u00e9st 7 x", "la table est le chat, the rat sat " * 3]
    for told in (model, cut):
        entropy, n = language.entropies(told, [*asked, None, "7 8"])
        assert n.tolist()[-2:] == [0, 0]
        for text, row in zip(asked, entropy):
            codes = language.letter_codes(text).tolist()
            codes = [0] * max(0, 4 - len(codes)) + codes
            some = [tuple(codes[i : i + 4]) for i in range(len(codes) - 3)]
            for k, lang in enumerate(told.languages):
                assert row[k] == pytest.approx(-sum(np.log(by_hand[lang](g)) for g in some) / len(some), rel=1e-5)


def test_kneser_ney_probabilities_add_up_to_one(small_model):
    """Over all letters and the one that stands for every unseen letter, after seen and unseen contexts."""
    texts, model, _ = small_model
    shard = language._shard(model.path, 0, model.discount.tobytes(), model.floor)
    letters = np.unique(np.concatenate([language.letter_codes(t) for ts in texts.values() for t in ts] + [np.array([0x7A], np.uint64)]))
    for context in (0x74_0068_0065, 0x7A007A007A, 0x20_0074_0068):
        asked = np.uint64(context) << np.uint64(16) | letters
        assert np.exp(shard.logs(asked).astype(float)).sum(axis=0) == pytest.approx(np.ones(len(model.languages)), rel=1e-5)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64])
def test_blocks_give_the_grams_of_the_whole_text(size):
    draw = random.Random(8)
    for _ in range(300):
        text = "".join(draw.choice("ab \u00e9.1\U00010400") for _ in range(draw.randint(0, 40)))
        whole = language.letter_codes(text)
        parts = [language.grams(b) for b in language.blocks(text, size)]
        assert np.concatenate([*parts, np.zeros(0, np.uint64)]).tolist() == (language.grams(whole).tolist() if len(whole) else [])


def test_rejection_both_ways(spark, make_docs, sf_dir):
    """True documents stay, whether learned from or not, whole or cut to some words; what is no language goes."""
    docs = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet")
    model = language.train(docs)
    rows = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang").collect()
    short = [(i, " ".join(t.split()[:n]), k) for (i, t, k), n in zip([tuple(r) for r in rows], [5, 8, 12, 20, 40] * len(rows))]
    got = language.judged(make_docs([(i, t, k) for i, t, k in short if language.letter_codes(t).any()]), model)
    assert got.where("rejected").count() <= 0.002 * len(short)
    whole = language.judged(docs, model).where("n_letters > 0")
    assert whole.where("rejected").count() <= 0.002 * len(rows)
    draw = random.Random(9)
    letters = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)) for n in (150, 400, 2000)]
    # no plain hexadecimal: the documents hold keys of it, which their languages learn
    coded = [base64.b64encode(draw.randbytes(n)).decode() for n in (150, 600)]
    source = ["for (int i = 0; i < n; ++i) { x[i] = foo(y[i] >> 3, &z); if (!ptr) return NULL; } #define QX 0x7f\n" * 4]
    other = ["\u65e5\u672c\u8a9e\u306e\u6587\u7ae0\u3067\u3059" * 20]
    assert language.judge(model, letters + coded + source + other)[-1].all()


def test_a_language_of_one_text_has_a_level(make_docs, prose):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5]
    docs = make_docs([(i, prose(60), "en") for i in ids[:30]] + [(ids[30], "\u00e9t\u00e9 \u00e0 la mer", "fr"), (ids[31], "7", "none")])
    model = language.train(docs)
    assert model.languages == ["en", "fr"] and np.isfinite(model.limits).all()
    assert not language.judge(model, [prose(10), "la mer \u00e9t\u00e9"])[-1].any()


# ---- registered queries with SQL --------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, sf_dir, name):
    assert spark_rows(queries.queries()[name](spark, sf_dir)) == duck_rows(duck(sf_dir), queries.oracle_sql()[name])
