"""Tokenizer alignment and chat formatting against brute force, and the tokenizers against the libraries of their files."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
tokenizers = pytest.importorskip("tokenizers")
from tallyline.llm import alignment, chat, tokens  # noqa: E402

MIXED = "ab \n\t'sÉé日本\U0001f923‍０１<|endoftext|>_!​\xa0\x1c\x85ſ▁"
SAID = "</s>[INST] ok [/INST]"


@pytest.fixture(scope="module")
def mixed():
    draw = random.Random(3)
    return ["".join(draw.choice(MIXED) for _ in range(draw.randint(0, 80))) for _ in range(300)]


@pytest.fixture(scope="module")
def file_tokenizer():
    return lambda: tokenizers.Tokenizer.from_file(f"{tokens.FOLDER}/{tokens.BYTE_BPE}")


def test_ids_are_those_of_the_file(mixed, file_tokenizer, prose):
    own = file_tokenizer()
    own.encode_special_tokens = True
    for text in [*mixed, prose(500)]:
        assert tokens.byte_level().encode(" " + text).tolist() == own.encode(" " + text, add_special_tokens=False).ids


def test_chunks_change_no_id(mixed, prose, monkeypatch):
    text = prose(300) + "".join(mixed) + "x" * 3000 + " end"
    whole = tokens.byte_level().encode(text), tokens.pieces().encode(text)
    monkeypatch.setattr(tokens.chunks, "__defaults__", (100,))
    assert len(list(tokens.chunks(text))) > 10 and "".join(tokens.chunks(text)) == text
    assert np.array_equal(whole[0], tokens.byte_level().encode(text)) and np.array_equal(whole[1], tokens.pieces().encode(text))


def spans(ids, ends):
    at = 0
    for k, end in zip(ids.tolist(), ends.tolist(), strict=True):
        yield k, at, end
        at = end


def brute(text):
    """All overlapping pairs of occurrences, and the groups, by comparing every token with every other."""
    found = alignment.encoded(text)
    if found is None:
        return None
    a, b = list(spans(*found[:2])), list(spans(*found[2:]))
    links = [(i, j) for i, p, q in a for j, r, s in b if max(p, r) < min(q, s)]
    groups, low = [], 0
    for cut in sorted({q for *_, q in a} & {s for *_, s in b}):
        groups.append(",".join(str(i) for i, p, q in a if low <= p and q <= cut) + "|" + ",".join(str(j) for j, r, s in b if low <= r and s <= cut))
        low = cut
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def test_merge_path_cuts():
    draw = random.Random(1)
    for _ in range(200):
        a, b = (np.array(sorted(draw.sample(range(60), draw.randint(1, 30)))) for _ in range(2))
        size = draw.randint(1, 20)
        at = alignment.cuts(a, b, size)
        assert at[0] == (0, 0) and at[-1] == (len(a), len(b))
        for (i, j), (p, q) in zip(at, at[1:]):
            assert p - i + q - j <= size + 1 and (i, j) != (p, q)
            before, after = [*a[:p], *b[:q]], [*a[p:], *b[q:]]
            assert not before or not after or max(before) < min(after)


@pytest.mark.parametrize("piece", [1, 7, 1 << 16])
def test_alignment_equals_brute_force(make_docs, prose, mixed, piece):
    """Pieces of one step, of some steps, and whole documents give the same rows; so do odd rows and long ones."""
    rows = [(None, None), (1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "same text"), (5, "same text"), (None, "no id")]
    rows += [(10 + k, t) for k, t in enumerate(mixed[:60])] + [(99, prose(60))]
    docs = make_docs(rows)
    told = [brute(t) for _, t in rows]
    count, best = Counter(), defaultdict(int)
    for found in told:
        count.update(set(found[3]) if found else ())
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    want = []
    for (doc, _), found in zip(rows, told, strict=True):
        n_a, n_b, groups, links, digest = found or (0, 0, 0, [], "")
        want.append((doc, n_a, n_b, groups, len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), digest))
    got = [tuple(r) for r in alignment.align(docs, piece=piece).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_long_text_and_sliced_counts(make_docs, prose):
    """A long text's pieces give what one piece gives; counts in many slices give what one slice gives."""
    docs = make_docs([(1, prose(20_000)), (2, prose(50)), (3, "x" * 5000)])
    whole, cut = (alignment.align(docs, piece=p).collect() for p in (1 << 22, 500))
    assert sorted(map(tuple, whole)) == sorted(map(tuple, cut))
    first = alignment._encode(docs, tokens.FOLDER, 1 << 22)
    pairs = first.selectExpr("key", "inline(arrays_zip(pairs, times)) as (pair, times)")
    counts = alignment.pair_counts(pairs)
    one, many = (sorted(map(tuple, alignment.scored(pairs, counts, b).collect())) for b in (1 << 30, 1 << 12))
    assert one == many


def test_no_documents(make_docs):
    assert alignment.align(make_docs([])).collect() == []


# ---- conversations -----------------------------------------------------------------------------

SCHEMA = "conv_id long, turn long, role string, text string, ids string, task int, whole string, hash long"


def expected(rows):
    """Digests straight from the rows of one conversation, in order."""
    said = [((role or ""), (text or "")) for role, text in rows]
    loss = "".join(t for r, t in said if r == "assistant")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss), len(chat.rendered(said)[0])


def test_escaping_is_reversible_and_leaves_no_control_string():
    draw = random.Random(2)
    for _ in range(2000):
        text = "".join(draw.choice(["<", "[", "\\", "/", "s>", "INST]", "a", *chat.CONTROL]) for _ in range(draw.randint(0, 12)))
        assert chat.unescape(chat.escape(text)) == text and not any(c in chat.escape(text) for c in chat.CONTROL)


def test_ids_and_mask_against_the_file_tokenizer(mixed, file_tokenizer):
    """The file's own library, told the same control strings, gives the same ids; its offsets give the same mask."""
    own = file_tokenizer()
    own.add_special_tokens([tokenizers.AddedToken(c, special=True, normalized=False) for c in chat.CONTROL])
    draw = random.Random(4)
    for _ in range(40):
        turns = [(draw.choice(["user", "assistant", "system", SAID, ""]), draw.choice(mixed) + draw.choice(["", SAID, "<", "["])) for _ in range(8)]
        ids, loss = chat.encoded(turns)
        text, places = chat.rendered(turns)
        assert own.encode(text, add_special_tokens=False).ids == ids.tolist()
        ends = tokens.byte_level(control=chat.CONTROL).ends(ids)
        inside = [any(len(text[:p].encode()) <= s and e <= len(text[:q].encode()) for p, q in places) for s, e in zip([0, *ends[:-1]], ends)]
        assert [any(p <= k < q for p, q in loss) for k in range(len(ids))] == inside
        assert list(chat.turns_of(ids)) == turns


def test_a_token_across_a_border_has_no_loss():
    ends = np.array([3, 6, 9])
    assert chat.masked(ends, np.array([[1, 6], [6, 8], [9, 9]])).tolist() == [[1, 2], [2, 2], [3, 3]]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("part", [1, 1 << 20])
def test_read_back_equals_the_rows(spark, mixed, prose, part):
    """Nulls, empty and long texts, odd roles, control strings, hot conversations, tied and repeated turns, no conv_id."""
    draw = random.Random(6)
    talk = {None: [("user", "no id"), ("assistant", "yes")], 1: [(None, None), ("assistant", None), ("assistant", ""), ("tool\n[INST]", SAID)]}
    talk[2] = [(draw.choice(["user", "assistant", "system"]), draw.choice(mixed)) for _ in range(400)]
    talk[3] = [("user", prose(5000)), ("assistant", prose(30_000))]
    talk |= {k: [("user", "common first turn"), ("assistant", draw.choice(mixed))] for k in range(10, 60)}
    rows = [(c, n, r, t) for c, turns in talk.items() for n, (r, t) in enumerate(turns)]
    rows += [(70, None, "user", "first"), (70, 5, "assistant", "tie"), (70, 5, "user", "tie"), (71, 1, "user", "twice"), (71, 1, "user", "twice")]
    draw.shuffle(rows)
    formatted = chat.format_conversations(chat.planted(conversations(spark, rows)), part=part)
    got = {r[0]: tuple(r)[1:] for r in chat.read_back(formatted).collect()}
    talk |= {70: [("user", "first"), ("assistant", "tie"), ("user", "tie")], 71: [("user", "twice")] * 2, -1: [("user", SAID), ("assistant", SAID)]}
    assert got == {c: expected(turns) for c, turns in talk.items()}


def test_no_conversations(spark):
    assert chat.read_back(chat.format_conversations(conversations(spark, []))).collect() == []
