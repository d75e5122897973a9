"""SimHash, substring and suffix-array dedup against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from cargoline.llm import simhash, substring, suffix
from cargoline.llm.components import connected_components


def test_components_join_chains_and_stars(spark):
    links = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(5, 5), (101, 100)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "hi long, lo long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    votes = np.zeros(64, int)
    for g in grams:
        votes += [xxhash.xxh64_intdigest(g, 42) >> b & 1 for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def test_near_duplicates_equal_brute_force(docs, rows):
    want, ids = [plain_fingerprint(r[1]) for r in rows], [r[0] for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            group[i] = min(group[j] for j in range(len(rows)) if (want[i] ^ want[j]).bit_count() <= 3)
    least = {g: min((i for i, x in zip(ids, group) if x == g and i is not None), default=None) for g in group}
    expected = Counter((i, f, least[g]) for i, f, g in zip(ids, want, group))
    got = Counter((r.id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))


def test_ball_links_find_every_distance(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 40)]
    fps = set(base)
    for k, f in enumerate(base):
        for d in (1, 2, 3, 4):
            bits = rng.choice(64, d, replace=False)
            fps.add(f ^ sum(1 << int(b) for b in bits))
    fps = sorted({f - 2**64 if f >= 2**63 else f for f in fps})
    found = connected_components(simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))).collect()
    root = {r.node: r.root for r in found}
    parent = {f: f for f in fps}

    def top(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) % 2**64).bit_count() <= 3:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    assert {f: root.get(f, f) for f in fps} == {f: top(f) for f in fps}


def unique(rows):
    """Rows equal in id and text are one document; ids in order, null first."""
    return sorted({(r[0], r[1]) for r in rows}, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))


def without_repeats(rows):
    seen, out = set(), {}
    for i, text in unique(rows):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for a in range(len(words) - 19):
            w = tuple(words[a : a + 20])
            if w in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(w)
        out[i, text] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g))
    return out


@pytest.mark.parametrize("hot", [2048, 1])
def test_substring_equals_brute_force(docs, rows, none, hot, monkeypatch):
    monkeypatch.setattr(substring, "HOT_CLASSES", hot)
    want = Counter((i, *w) for i, w in [(r[0], without_repeats(rows)[r[0], r[1]]) for r in rows])
    got = substring.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), b" ".join(r.kept.encode().split())) for r in got) == want
    assert substring.remove_repeats(none).count() == 0


def test_removal_keeps_rows_and_columns(docs, rows):
    out = substring.apply_removal(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert all(r.n_chars == len(r.text or "") for r in out.collect() if r.doc_id is not None)


@pytest.mark.parametrize("hot", [2048, 1])
def test_suffix_array_equals_brute_force(docs, rows, none, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT_CLASSES", hot)
    counts = Counter(b[a : a + 200] for _, t in unique(rows) for b in [(t or "").encode()] for a in range(len(b) - 199))
    want = Counter()
    for r in rows:
        b = (r[1] or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - 199):
            if counts[b[a : a + 200]] > 1:
                gone[a : a + 200] = b"\1" * 200
        want[r[0], len(b), sum(gone), bytes(x for x, g in zip(b, gone) if not g)] += 1
    got = suffix.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), bytes(r.kept)) for r in got) == want
    assert suffix.remove_repeats(none).count() == 0


def test_maximal_repeats_by_definition():
    rng = np.random.default_rng(1)
    blocks = [bytes(rng.integers(97, 99, n).tolist()) for n in (40, 25, 1, 33)]
    where = defaultdict(set)
    joined, heads = b"".join(blocks), np.cumsum([0, *map(len, blocks)])
    for h, b in zip(heads, blocks):
        for i in range(len(b)):
            for j in range(i + 4, len(b) + 1):
                where[b[i:j]].add(int(h) + i)
    want = set()
    for s, at in where.items():
        left = {joined[p - 1 : p] if p not in heads else p for p in at}
        right = {joined[p + len(s) : p + len(s) + 1] if p + len(s) not in heads else -p for p in at}
        if len(at) > 1 and len(left) > 1 and len(right) > 1:
            want.add((len(s), tuple(sorted(at))))
    assert {(n, tuple(sorted(p.tolist()))) for n, p in suffix.maximal_repeats(blocks, 4)} == want


def test_digest_of_empty_text_is_sha_of_nothing(docs):
    found = suffix.remove_repeats(docs.where("text = ''")).collect()
    assert [hashlib.sha256(bytes(r.kept)).hexdigest() for r in found] == [hashlib.sha256(b"").hexdigest()]


def test_texts_are_cut_into_runs_once(docs, tmp_path):
    """Both passes over the runs read what the first one wrote."""
    import os

    from cargoline.llm.runs import candidates, run_rows, squeezed, unsqueezed
    from cargoline.llm.substring import word_symbols

    log, plain = str(tmp_path), word_symbols()

    def symbols(text):
        with open(os.path.join(log, "cut"), "ab") as f:
            f.write(b".")
        return plain(text)

    candidates(run_rows(docs, symbols, 20, 4, "doc_id", "text"), "counted").count()
    assert os.path.getsize(os.path.join(log, "cut")) == docs.count()
    assert all(unsqueezed(squeezed(x)) == x for x in (b"", b"a", "ñ \0 ".encode() * 5000))


def test_all_runs_are_deleted_once_the_candidates_are_written(spark, docs):
    """Only the runs whose anchor recurs stay on disk."""
    import os
    import uuid

    from cargoline.llm.runs import candidates, run_rows
    from cargoline.llm.substring import word_symbols
    from cargoline.session import scratch_path
    from cargoline.storage import children

    own = f"left-{uuid.uuid4().hex}"  # the scratch folder may be that of other runs, too
    found = candidates(run_rows(docs, word_symbols(), 20, 4, "doc_id", "text"), own)
    names = [n.rpartition("-")[0] for n in children(spark, os.path.dirname(scratch_path(spark, "x")))]
    assert [n for n in names if n.startswith(f"llm-{own}")] == [f"llm-{own}"]
    assert found.count() > 0
