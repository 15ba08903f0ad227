"""The conversation trie, lexical search and packing against plain versions, and on odd and empty tables."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import DOCS, SMALL, odd_rows

from balcao.llm import packing, queries, treap, trie

TURNS = "conv_id bigint, turn bigint, role string, text string, n_convs long, parent string, path string"


def plain_trie(sequences):
    """{(conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends)} from {conv_id: [(role, text)]}."""
    members = defaultdict(list)
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            members[tuple(sequences[c][:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    saved = {p: (len(m) - 1) * (len(p[-1][1].encode()) if p else 0) for p, m in members.items()}
    leaves, total = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            total[p[:d]] += saved[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(sequences[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        out.append((m[0], len(p), parent, len(m), kids[p], leaves[p], total[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def odd_conversations():
    rnd = random.Random(3)
    rows = []
    for c in range(300):
        for t in range(rnd.choice([1, 2, 3, 3, 4, 9])):
            rows.append((c, t, rnd.choice(["user", "assistant", None]) if t > 2 else "user", rnd.choice(["a", "ü", "", None]) if t else "hello " * 5))
    rows += [(1000 + c, t, "user", f"copied {t}") for c in range(150) for t in range(6)]
    rows += [(2000, t, "user", "long") for t in range(700)] + [(2001, None, "user", "x"), (2001, 0, "user", "y"), (None, 0, "user", "z")]
    return [(*r, 0, "p", "q") for r in rows]


def sequences_of(rows):
    held = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            held[c].append(((t is not None, t or 0), role or "", text or ""))
    return {c: [(r, x) for _, r, x in sorted(v, key=lambda s: s[0])] for c, v in held.items()}


@pytest.mark.parametrize("shard_turns", [40, 1 << 18])
def test_trie_equals_a_plain_one(spark, shard_turns):
    rows = odd_conversations()
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    found = trie.trie(trie.paths(turns), shard_turns)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_trie(sequences_of(rows))
    named = turns.where("conv_id IS NOT NULL").withColumn("conv_id", F.format_string("%06d", "conv_id"))
    assert trie.trie(trie.paths(named), shard_turns).count() == found.count()


def test_trie_of_no_conversations_and_of_empty_ones(spark):
    none = trie.paths(spark.createDataFrame([], TURNS))
    assert trie.trie(none).count() == 0
    empty = spark.createDataFrame([(7, []), (3, [])], "conv_id bigint, path array<struct<digest: string, bytes: int>>")
    assert [tuple(r) for r in trie.trie(empty).collect()] == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,7").hexdigest())]


def test_parentheses_close_as_a_stack_does():
    rnd = random.Random(1)
    for n in (1, 2, 70, 5000):
        depth, bits = 0, []
        while bits.count(1) < n:
            if depth and rnd.random() < 0.49:
                bits, depth = [*bits, 0], depth - 1
            else:
                bits, depth = [*bits, 1], depth + 1
        bits += [0] * depth
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(bits)
        bits = np.array([1, *bits, 0], bool)  # one tree
        assert trie.Parens(bits).findclose(opens + 1).tolist() == [want[i] + 1 for i in opens.tolist()]
        assert trie.Parens(bits).findclose(np.array([0])).tolist() == [len(bits) - 1]


def words_of(text):
    import re

    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    held = [(i, Counter(words_of(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in items:
        ranked = []
        for doc, counts in held:
            m = 100 - 25 + (25 * sum(counts.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * counts[w]) // (1000 * counts[w] + 12 * m))
                for w in words_of(text) if counts[w]
            )
            if score > 0:
                ranked.append((-score, doc is not None, doc or 0, doc))
        out += [(item, n + 1, doc, -s) for n, (s, _, _, doc) in enumerate(sorted(ranked)[:k])]
    return sorted(out, key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    docs = spark.createDataFrame(odd_rows(), DOCS).repartition(3)
    rows = [(r[0], r[1]) for r in odd_rows()]
    items = [(1, "The and of her thing"), (2, None), (3, ""), (4, rows[3][1]), (None, "ü日本 12 b b b"), (5, "nowhere " * 3), (6, rows[9][1] * 3)]
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    built, n_docs = treap.index(docs)
    for block in (512, 2):
        monkeypatch.setattr(treap, "BLOCK", block)
        for k in (1, 4, 20):
            found = treap.search(built, n_docs, asked, k)
            assert sorted((tuple(r) for r in found.collect()), key=str) == plain_search(rows, items, k)
    nothing, n = treap.index(docs.limit(0))
    assert n == 0 and treap.search(nothing, n, asked, 5).count() == 0
    assert treap.search(built, n_docs, asked.limit(0), 5).count() == 0
    named = treap.search(*treap.index(docs.withColumn("doc_id", F.col("doc_id").cast("string"))), asked, 3)
    assert named.count() == len(plain_search(rows, items, 3))


def test_treap_holds_every_cell_and_bounds_what_is_below():
    rng = np.random.default_rng(2)
    cells = np.unique(rng.integers(0, 500 * 60, 4000))
    rows, cols, values = cells // 60, cells % 60, rng.integers(1, 10**6, len(cells))
    tree = treap.Treap(treap.grown(rows, cols, values))
    assert sorted(zip(tree.rows[:-1], tree.cols[:-1], tree.values[:-1])) == sorted(zip(rows, cols, values))
    for node in range(len(tree.masks) - 1):
        kids = tree.first[node] + np.arange(bin(tree.masks[node]).count("1"))
        assert (tree.values[kids] <= tree.values[node]).all()
    wanted = np.array([3, 77, 499])
    scores = np.zeros(60, np.int64)
    for row, w in zip(wanted, (5, 1, 9)):
        scores[cols[rows == row]] += w * values[rows == row]
    cols_found, best = tree.best(wanted, np.array([5, 1, 9]), 4, 1, 60)
    assert sorted(best)[-4:] == sorted(scores)[-4:] and (scores[cols_found] == best).all()


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def check_packing(found, texts, tokenizer, limit):
    """Whole, gapless and within the limit; returns the number of sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        got = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc])
        cuts = range(0, len(ids), limit)
        assert got == [(i, a, len(ids[a : a + limit]), zlib.crc32(np.array(ids[a : a + limit], "<u4").tobytes())) for i, a in enumerate(cuts)]
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= limit
    return len(by_sequence)


def test_packing_is_whole_and_tight(spark):
    path, tokenizer = library()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    found = queries.op13_genetic_packing(spark, "/root/testdata/sf0.01").collect()
    n = check_packing(found, texts, tokenizer, 4096)
    assert n <= 1.01 * sum(r.length for r in found) / 4096 + 1


def test_packing_in_many_shards(spark, monkeypatch):
    path, tokenizer = library()
    monkeypatch.setattr(packing, "SHARD_PIECES", 40)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    found = packing.pack(packing.pieces(docs, path, 512, 1), 512).collect()
    n = check_packing(found, texts, tokenizer, 512)
    assert n <= 1.05 * sum(r.length for r in found) / 512


def test_packing_of_odd_texts(spark):
    path, tokenizer = library()
    texts = [
        *(r[1] for r in odd_rows()), "<|endoftext|> a <|ENDOFTEXT|>b.<|startoftext|>", "ΑΣ. Σ.ας ΑΣ,x", "é. É! don't. I'M, we'll's", "a\x1cb\x85c d e",
        "1234.5!? ...x", "ﬁ Ⅷ ½ İI ǅ", "a\x00b", "x.y,z:A;B!c?d",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumns({"bin": F.lit(1), "shard": F.lit("s"), "item": F.lit(0)})
    found = packing.pack(packing.pieces(rows, path, 128, 1), 128).collect()
    check_packing(found, dict(enumerate(texts)), tokenizer, 128)
    odd = spark.createDataFrame(odd_rows(), DOCS)
    assert packing.pack(packing.pieces(odd, path, 4096, 1), 4096).agg(F.count_if(F.col("piece") == 0)).first()[0] == 20
    assert packing.pack(packing.pieces(odd.limit(0), path, 4096, 1), 4096).count() == 0


def test_crossover_keeps_every_piece_and_whole_bins():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 300, 400)
    mother, father = packing.first_packings(lengths, 512, 2, rng)
    for _ in range(20):
        child = packing.crossover(lengths, mother, father, 512, rng)
        assert packing.fills(lengths, child).max() <= 512 and len(child) == 400 and child.min() == 0
        assert (np.bincount(child) > 0).all()
    same = {frozenset(np.flatnonzero(father == b)) for b in range(father.max() + 1)} & {frozenset(np.flatnonzero(child == b)) for b in range(child.max() + 1)}
    assert same
    better = packing.evolve(lengths, [], 512, 1)
    assert packing.fitness(lengths, better[0], 512) >= packing.fitness(lengths, mother, 512)


def test_learned_words_are_forgotten_in_time(monkeypatch):
    path, tokenizer = library()
    monkeypatch.setattr(packing, "WORDS_KNOWN", 5)
    known = packing.WordIds(path)
    for texts in (["one two", None, "three four. Two"], ["five six seven one"], ["eight"]):
        ids, starts = known.encode(pa.array(texts, pa.string()))
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == want
    assert len(known.known) <= 5 or len(known.known) == 1
