"""The Merkle manifest against trees built in one piece, tier by tier and copy by copy."""

import hashlib
import zlib

import pytest

from tallyline.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def rebuilt(rows):
    """Expected rows; each tampered document by a rebuild of the whole forest with its leaf exchanged."""
    sources = {}
    for r in rows:
        text = r["text"]
        if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        sources.setdefault(r["source"], []).append((r["doc_id"], leaf(r, r["text"]), leaf(r, text)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for docs in sources.values():
        docs.sort(key=lambda d: (d[0] is not None, d[0] or 0, d[1], d[2]))

    def root(exchange=None):
        subs = []
        for s in order:
            nodes = [d[1] for d in sources[s]]
            if exchange and exchange[0] == s:
                nodes[exchange[1]] = exchange[2]
            subs.append(levels(nodes))
        return subs, levels([x[-1][0] for x in subs])

    subs, top = root()
    for k, s in enumerate(order):
        for i, (doc, own, new) in enumerate(sources[s]):
            proof = ""
            for tree, at in ((subs[k], i), (top, k)):
                for level in tree[:-1]:
                    run = at // 3 * 3
                    proof += "".join(level[run:at] + level[at + 1 : run + 3])
                    at //= 3
            folded = root((s, i, new))[1][-1][0] if new != own else top[-1][0]
            yield (doc, own, subs[k][-1][0], top[-1][0], h(proof), folded, folded == top[-1][0])


def check(docs, height):
    manifest = merkle.build(docs, merkle.without_line_ends(merkle.chosen()), height)
    got = [tuple(r) for r in merkle.verify(manifest).collect()]
    want = list(rebuilt([r.asDict() for r in docs.collect()]))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    return manifest, got


@pytest.mark.parametrize("height", [1, 2, 7])
def test_equals_whole_rebuilds(make_docs, odd_rows, height):
    """Small blocks make several tiers, also of the sources' own tree."""
    many = [(100 + k, f"line {k}\nsecond", "en", f"s{k % 13}" if k % 3 else "hot") for k in range(200)]
    rows = odd_rows + many + [(900, "a\nb", None, ""), (901, "\n", "en", None), (902, None, "en", "only\none")]
    _, got = check(make_docs(rows), height)
    assert {r[6] for r in got} == {True, False}


def test_versions_share_what_they_do_not_copy(make_docs):
    docs = make_docs([(k, f"a{k}\nb", "en", "x") for k in range(40)])
    manifest = merkle.build(docs, merkle.without_line_ends(merkle.chosen()), 2)
    rows = merkle.verify(manifest, copies=True).collect()
    stored = levels([r["leaf"] for r in sorted(rows, key=lambda r: r["doc_id"])])
    for r in rows:
        assert (r["copied"] is None) == r["verified"]
        if r["copied"]:
            # one node a level is copied, and each follows from the one below and stored siblings
            assert len(r["copied"]) == len(stored)
            at = r["doc_id"]
            for below, above, level in zip(r["copied"], r["copied"][1:], stored):
                run = level[at // 3 * 3 : at // 3 * 3 + 3]
                run[at % 3] = below
                assert h("".join(run)) == above and above not in {n for x in stored for n in x}
                at //= 3


def test_few_rows(make_docs):
    assert check(make_docs([]), 7)[1] == []
    _, got = check(make_docs([(5, "x\ny", "en", None)]), 7)
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")


def test_input_without_tampering(make_docs):
    docs = make_docs([(k, "a\nb", "en", "x") for k in range(5)])
    assert all(r["verified"] for r in merkle.verify(merkle.build(docs)).collect())
