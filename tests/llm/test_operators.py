"""Operators against plain versions and SQL, and on nulls, ties, repeats, empty and odd tables."""

import hashlib
import io
import random
import zlib

import brute
import numpy as np
import oracle_check
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from balcao.llm import chat, decontam, langid, mixing, neardup, pii, quality, queries, suffix, tokens, warc
from balcao.llm.components import components

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, kept boolean, row string"
WORDS = "the and of her thing onth erin sto hand ly ent ing ou ti wh".split()


def prose(n, seed):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n))


def odd_rows():
    """Null, empty and blank texts, null ids and sources, ties, repeats, copies, near copies, and a very long text."""
    base, other = prose(120, 1), prose(300, 2)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    texts = [
        (1, None), (2, ""), (3, " \t\n"), (4, base), (4, base), (5, base.upper()), (6, near), (None, base), (None, other), (7, other),
        (7, prose(80, 3)), (8, "one two three"), (9, "one two three"), (10, "one two"), (11, "12 34!"), (12, "a\x00b \u00a0 ü日本 " * 30),
        (13, prose(20000, 4)), (14, "x " * 900), (15, prose(40, 5) + " " + other + " " + prose(40, 6)), (-3, "é" * 250),
    ]
    return [(i, t, "en" if i != 9 else None, None if i == 7 else f"s{(i or 0) % 3}", 0, 1, True, "r") for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    if name in queries.SQL:
        con = oracle_check.connect(SMALL)
        found = queries.QUERIES[name](spark, SMALL)
        columns = sorted(found.columns)
        want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
        assert sorted(map(repr, found.select(*columns).toLocalIterator())) and sorted(
            repr(tuple(r)) for r in found.select(*columns).collect()
        ) == sorted(map(repr, want))
    else:
        found = queries.QUERIES[name](spark, SMALL)
        # One row per document; op13 gives one per piece, and every document has a first piece.
        assert (found.where("piece = 0") if "piece" in found.columns else found).count() == 200


def test_language_is_right_on_held_out_documents(spark):
    found = queries.op1_language_profiles(spark, "/root/testdata/sf0.01").where("held_out")
    langs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.join(langs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98


def test_languages_equal_brute_force(spark, odd):
    for docs in (spark.read.parquet(f"{SMALL}/documents.parquet"), odd):
        rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
        found = sorted((str(r.doc_id), r.lang_pred, round(r.score, 9)) for r in langid.identify(docs).collect())
        assert found == sorted((str(d), p, round(s, 9)) for d, p, s in brute.languages(rows, lambda d: zlib.crc32(str(d).encode()) % 5 == 0))


def test_language_of_odd_rows(odd, none):
    found = {(r.doc_id, r.lang_pred) for r in langid.identify(odd).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (11, "und"), (4, "en")} <= found
    assert langid.identify(none).count() == 0
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = langid.keep_known(odd)
    assert kept.columns == odd.columns and kept.where("doc_id IN (1, 2, 3, 11)").count() == 0
    assert kept.where("doc_id = 4").count() == 2


def test_quality_order_does_not_change_the_verdict(odd, none):
    found = quality.quality(odd)
    want = sorted(map(str, found.collect()))
    for order in (list(quality.RULES), list(quality.RULES)[::-1]):
        column = quality.assess(F.col("text"), order, quality.RULES)
        rows = odd.select("doc_id", column.alias("f")).select("doc_id", "f.*")
        assert sorted(map(str, rows.collect())) == want
    assert quality.quality(none).count() == 0
    assert quality.cheapest_order([("slow", 4.0, 0.5), ("fast", 1.0, 0.5), ("idle", 0.1, 0.0)]) == ["fast", "slow", "idle"]


def test_tokens_equal_the_library(spark, odd, none):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [r[0] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    texts += [r[1] for r in odd_rows()] + ["<s></s> <unk>", "\u2581x \u2581", "  a   b \n\n c\t", "👩‍👩‍👧½ﬁ" * 9, "a" * 3000]
    count = tokens.vocabulary(path).count
    assert [count(t) for t in texts] == [len(library.encode(t or "")) for t in texts]
    assert tokens.token_counts(odd, path, 4096).count() == 20 and tokens.token_counts(none, path, 1).count() == 0


def test_near_duplicates_equal_brute_force(odd, none, spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    for shingle in (4, 5):
        found = sorted(map(repr, (tuple(r)[:3] for r in neardup.near_duplicates(odd, shingle=shingle).collect())))
        assert found == sorted(map(repr, brute.near_duplicates(rows, shingle, 80)))
    assert neardup.near_duplicates(none).count() == 0 and neardup.keep_first(none).count() == 0
    kept = neardup.keep_first(odd)
    assert kept.columns == odd.columns
    # 4, its repeat, 5, 6 and the row without an id are one group; 8 and 9 another; 7 and the null id a third
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 7, 7, 8, 10, 11, 12, 13, 14, 15, -3]))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    all_rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = sorted(tuple(r)[:3] for r in neardup.near_duplicates(docs, shingle=4).collect())
    assert found == sorted(brute.near_duplicates(all_rows, 4, 80))


def test_a_large_group_of_near_copies_around_one_text(spark):
    rnd = random.Random(5)
    base = prose(150, 9).split()
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rnd.randrange(7)):
            words[rnd.randrange(150)] = f"w{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:30]) + " " + prose(60, 100 + i)) for i in range(60)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=4).collect()
    assert sorted(tuple(r)[:3] for r in found) == sorted(brute.near_duplicates(rows, 4, 80))


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (200, 200), (7, 300)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys([*range(61), 300], 0), 100: 100, 101: 100}


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("hot", [suffix.HOT, 1])
def test_repeats_equal_brute_force(spark, odd, keep_first, hot):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = sorted(tuple(r)[:5] for r in suffix.remove_repeats(docs, keep_first=keep_first, hot=hot).collect())
    assert found == sorted(brute.removals(rows, 200, keep_first))
    if not keep_first:
        found = [repr(tuple(r)[:5]) for r in suffix.remove_repeats(odd, keep_first=False, hot=hot).collect()]
        assert sorted(found) == sorted(map(repr, brute.removals([(r[0], r[1]) for r in odd_rows()], 200, False)))


def test_repeats_keep_the_first_copy(odd, none):
    found = {}
    for r in suffix.remove_repeats(odd).collect():
        found.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed))
    assert len(set(found[4])) == 1 and found[4][0][1] == 0  # rows repeated under the first id
    assert (found[15][0][1] > 0) and suffix.remove_repeats(none).count() == 0


def test_factors_equal_a_plain_array(monkeypatch):
    """Longest previous factors around one anchor, among all suffixes at the same distance to it."""
    monkeypatch.setattr(suffix, "GRAM", 4)
    length, left = 8, 4
    rnd = random.Random(7)
    for _ in range(40):
        n = rnd.randrange(2, 40)
        rows = [bytes(rnd.choice(b"ab") for _ in range(left)) + b"ANCH" + bytes(rnd.choice(b"ab") for _ in range(length - 4)) for _ in range(n)]
        around = np.frombuffer(b"".join(rows), np.uint8).reshape(n, -1)
        near, far = np.array([rnd.randrange(3) for _ in rows]), np.array([rnd.randrange(2, left + 1) for _ in rows])
        rank = np.array(rnd.sample(range(n), n))
        found = suffix.factors(np.zeros(n, np.int64), around, near, far, rank, length)
        for i in range(n):
            for d in range(left + 1):
                want = 0
                if near[i] <= d <= far[i]:
                    for j in range(n):
                        if rank[j] < rank[i] and near[j] <= d <= far[j]:
                            a, b = rows[i][left - d :], rows[j][left - d :]
                            want = max(want, next((k for k in range(len(a)) if a[k] != b[k]), len(a)))
                assert found[i, d] == (want if want >= length else 0)


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    text = prose(4000, 8).encode()
    whole = suffix.Anchors(text)
    monkeypatch.setattr(suffix, "PIECE", 1000)
    parts = suffix.Anchors(text)
    starts = lambda a: sorted((s, h) for h, f, t in zip(a.hashes, a.first, a.last) for s in range(f, t + 1))
    assert starts(whole) == starts(parts)


def test_contamination_of_odd_rows(spark, odd, none):
    base = prose(120, 1)
    items = [(1, " ".join(base.split()[5:30])), (2, "one two"), (None, "three"), (3, None), (4, ""), (2, "one two"), (10, "A\u00a0B")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, words string")
    found = {}
    for r in decontam.overlaps(odd, benchmark).collect():
        found.setdefault(r.row.doc_id, []).append((r.n_words, r.n_hit, r["items"]))
    assert found[1] == [(0, 0, [])] and found[4] == [(120, 25, ["1"])] * 2 and found[8] == [(3, 3, ["2"])] and found[10] == [(2, 2, ["2"])]
    assert sorted(found[7])[0][1] == 0
    clean = decontam.clean_rows(odd, benchmark)
    assert clean.columns == odd.columns and clean.where("doc_id IN (4, 5, 8)").count() == 0
    assert decontam.clean_rows(none, benchmark).count() == 0
    assert decontam.clean_rows(odd, benchmark.limit(0)).count() == odd.count()


def test_only_whole_windows_are_candidates(spark):
    line = " ".join(f"line{i}" for i in range(decontam.WINDOW))
    items = [(i, f"{line} own{i}") for i in range(200)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"other text {line} with no item"), (2, f"x {line} own7")], "doc_id bigint, text string")
    windows = decontam.benchmark_windows(benchmark)
    maps = [decontam._map_of(windows, c, decontam.LEAST_BITS) for c in ("print", "whole")]
    told = docs.select("doc_id", decontam._candidates(F.col("text"), *maps, []).alias("c"))
    assert {r.doc_id: r.c.n_words for r in told.collect()} == {1: 18, 2: 15}
    found = told.select("doc_id", F.explode("c.found").alias("one")).select("doc_id", "one.*")
    met = found.join(windows.select("print", "place", "size", "digest").distinct(), ["print", "place", "size", "digest"])
    assert sorted((r.doc_id, r.start, r.size) for r in met.collect()) == [(1, 2, 13), (2, 1, 13), (2, 2, 13)]
    assert {r.row.doc_id: (r.n_hit, len(r["items"])) for r in decontam.overlaps(docs, benchmark).collect()} == {1: (13, 200), 2: (14, 200)}


def test_rows_without_an_id_do_not_meet(spark):
    """Many texts without an id, or under one id, each have their own hits; so do repeated rows."""
    item = prose(60, 40)
    words = item.split()
    texts = [prose(30, 100 + i) + " " + " ".join(words[i % 40 : i % 40 + 15]) for i in range(300)]
    rows = [(None if i % 2 else 7, t) for i, t in enumerate(texts)] + [(None, texts[1])] * 3
    benchmark = spark.createDataFrame([(1, item), (2, item)], "item_id bigint, text string")
    own = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id bigint, text string")
    found = decontam.overlaps(spark.createDataFrame(rows, "doc_id bigint, text string"), benchmark).collect()
    want = decontam.overlaps(own, benchmark).collect()
    assert sorted((r.row.text, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == sorted((r.row.text, r.n_words, r.n_hit, tuple(r["items"])) for r in want)
    assert {r.n_hit for r in want} <= {15, 16} and {tuple(r["items"]) for r in want} == {("1", "2")}


def test_pseudonyms_keep_format_and_links():
    one = pii.Pseudonyms("k")
    text = (
        'joe.x99@mail7.example.com +1 (974) 555-3436 token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" 4845168114407329, '
        "4111 1111 1111 1111 97.51.17.173 123-45-6789 2024-02-29 31/12/1999 12/31/1999 GB82 WEST 1234 5698 7654 32 joe.x99@mail7.example.com"
    )
    new, found = one.replace(text)
    kinds = [k for k, _, _ in found]
    assert kinds == ["email", "phone", "secret", "card", "card", "ip", "national_id", "date", "date", "date", "iban", "email"]
    for kind, start, end in found:
        value = text[start:end]
        assert value not in new and one.restore(kind, one.moved(kind, value)) == value
    assert [k for k, _, _ in one.replace(new)[1]] == kinds and pii.Pseudonyms("other").replace(text)[0] != new
    assert new.split()[0] == new.split()[-1]
    for same in ("version 3.14", "9807915762804490", "999.1.1.1", "2023-02-29", "000-12-3456", None, "", "plain"):
        assert one.replace(same) == (same, [])


def test_secrets_of_any_length_and_with_dots():
    one = pii.Pseudonyms("k")
    for value in ("0a" * 256 + "b", "Ab1-_" * 40_000, "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.dBjftJeZ4CVP-mB92K27uhbUJU1p1r"):
        new, found = one.replace(f'x token = "{value}" y')
        assert found == [("secret", 11, 11 + len(value))] and len(new) == len(value) + 14
        moved = new[11:-3]
        assert all(a != b for a, b in zip(moved.split("."), value.split("."))) and one.restore("secret", moved) == value
    same = "see '" + "a1." * 300 + "'"
    assert one.replace(same) == (same, [])


def test_spellings_of_one_value_stay_linked():
    one = pii.Pseudonyms("k")
    phones = ["+1 (743) 555-3824", "+1 743 555 3824", "+1.743.555.3824", "(743) 555-3824", "743-555-3824"]
    moved = [one.moved("phone", p) for p in phones]
    assert [one.replace(p)[0] for p in phones] == moved and [one.restore("phone", m) for m in moved] == phones
    assert len({"".join(c for c in m if c.isdigit())[-10:] for m in moved}) == 1 and moved[0].startswith("+1 (")
    assert one.moved("phone", "+44 20 7946 0958").replace(" ", "") == one.moved("phone", "+44-207-946-0958").replace("-", "")
    for dates in (["2024-02-28", "28/02/2024", "28.02.2024", "02/28/2024"], ["2024-02-09", "09/02/2024"]):
        moved = [one.moved("date", d) for d in dates]
        assert [one.replace(d)[0] for d in dates] == moved and [one.restore("date", m) for m in moved] == dates
        y, m, d = moved[0].split("-")
        assert moved[1:] == [f"{d}/{m}/{y}", f"{d}.{m}.{y}", f"{m}/{d}/{y}"][: len(dates) - 1] and moved[0] != dates[0]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation(size):
    f = pii.Feistel(b"k")
    moved = [f.permute(i, size, "t") for i in range(size)]
    assert sorted(moved) == list(range(size)) and [f.permute(i, size, "t", True) for i in moved] == list(range(size))


def test_the_key_comes_from_the_session(spark):
    made = pii.key_of(spark)
    assert len(made) == 64 and pii.key_of(spark) == made
    spark.conf.set(pii.KEY_SETTING, "own")
    try:
        assert pii.key_of(spark) == "own"
    finally:
        spark.conf.unset(pii.KEY_SETTING)


def test_pseudonymized_rows(odd, none):
    assert pii.pseudonymize_rows(odd, "k").columns == odd.columns
    assert pii.pseudonymize(odd, "k").where("text IS NULL").count() == 1 and pii.pseudonymize(none, "k").count() == 0


def test_mix_stays_within_a_block(spark, odd, none):
    rows = [(i, f"s{min(i % 10, 4)}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string")
    weights = spark.createDataFrame([("s0", 5), ("s1", 3), ("s2", 1), ("s3", 1), ("s4", 2)], "source string, weight bigint")
    shares = {r.source: r.slots for r in mixing.whole_slots(weights, 97).collect()}
    period = sum(shares.values())
    found = mixing.mix(docs, weights, block_rows=8, period=97).select("row.source", "row.doc_id", "block", "slot", "place").collect()
    assert sorted(r.doc_id for r in found) == list(range(6000))
    at = {}
    for r in found:
        assert at.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)  # a slot holds one block
    ends = min(max(s for s, b in at.items() if b[0] == source) for source in shares)
    done = dict.fromkeys(shares, 0)
    for slot in range(ends):
        done[at[slot][0]] += 1
        assert all(abs(done[s] * period - shares[s] * (slot + 1)) < period for s in shares)
    mixed = mixing.mix(odd, mixing.root_weights(odd), block_rows=2)
    assert mixed.count() == odd.count() and mixing.mix(none, mixing.root_weights(none)).count() == 0
    assert mixing.in_order(mixed, odd.columns).columns == [*odd.columns, "mix_slot", "mix_place"]


def test_mix_keeps_exact_weights(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 19}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string")
    weights = {r.source: r.weight for r in mixing.root_weights(docs).collect()}
    found = mixing.mix(docs, mixing.root_weights(docs), block_rows=1).select("row.source", "row.doc_id", "block", "slot").collect()
    assert sorted(r.doc_id for r in found) == list(range(3000)) and len({r.slot for r in found}) == 3000
    total = sum(weights.values())
    for r in found:  # each block within its window: less than one block from the target weight
        assert r.block * total // weights[r.source] <= r.slot < -(-(r.block + 1) * total // weights[r.source])


def test_archives_round_trip(spark, tmp_path):
    pages = [(1, "u1", "same"), (2, "u2", "same"), (2, "u2", "same"), (3, None, None), (4, "u4", ""), (None, "u", "same"), (5, "u\r\n5", "é" * 9)]
    pages += [(10 + i, f"http://x/{i}", f"<html>{prose(100, i)}</html>") for i in range(300)]
    rows = spark.createDataFrame([(*p, 0) for p in pages], "page_id bigint, url string, html string, digest int")
    found = warc.read_archives(warc.write_archives(warc.marked(rows).repartition(2), str(tmp_path), 4000)).collect()
    assert len(found) == len(pages)
    told = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found), key=repr)[:8]
    assert (1, 4, "revisit", 2) in told or (1, 4, "revisit", 2) in {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found}
    by = {}
    for r in found:
        by.setdefault(r.page_id, []).append(r)
    assert [r.record_type for r in by[2]] == ["response"] * 2 and by[None][0].refers_to == 2 and by[3][0].refers_to == 4
    assert all(bytes(by[i][0].payload).decode() == html for i, _, html in pages[7:])
    assert warc.read_archives(warc.write_archives(warc.marked(rows.limit(0)), str(tmp_path))).count() == 0


def test_damaged_archives_are_refused():
    page = [warc.encode(i, "u", prose(60, i).encode(), None, False) for i in range(600)]
    out = io.BytesIO()
    writer = warc.ArchiveWriter(out, warc.dictionary_for(page))
    for one in page:
        writer.add(one)
    data = out.getvalue()
    assert data[:4] == b"\x5d\x2a\x4d\x18" and list(warc.records(io.BytesIO(data))) == page
    for broken in (data[:-5], data[:100], data + b"junk!", data[:4] + b"\x01\0\0\0" + data[8:]):
        with pytest.raises(warc.WarcError):
            list(warc.records(io.BytesIO(broken)))
    good = page[0]
    for broken in (good[:-1], good + b"x", good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"WARC-Date", b"Date"), good[:-20] + b"?" + good[-19:]):
        with pytest.raises(warc.WarcError):
            warc.decode(broken)


def test_chat_examples(spark):
    tricky = "\\### a: </turn>\n \\\\ ### </turn> "
    turns = [
        (1, 0, "system", "s"), (1, 1, "user", tricky), (1, 2, "assistant", tricky), (1, 3, "user", None), (1, 4, "assistant", "end"),
        (2, 0, "user", "alone"), (3, None, None, "x"), (3, 1, "assistant", ""), (None, 5, "assistant", "a"), (4, 1, "x: y:", ""), (4, 1, "x: y:", ""),
    ]
    rows = spark.createDataFrame([(*t, 7) for t in turns], "conv_id bigint, turn int, role string, text string, size int")
    records = chat.examples(rows)
    assert sorted(str(r.target) for r in records.where("conv_id = 1").collect()) == ["2", "4"]
    found = {r.conv_id: r for r in chat.read_back(records).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert found[1].n_turns == 5 and found[1].loss_sha256 == sha(tricky + "end")
    assert found[1].turns_sha256 == sha(f"system\ns\nuser\n{tricky}\nassistant\n{tricky}\nuser\n\nassistant\nend\n")
    assert found[2].loss_chars == 0 and found[3].turns_sha256 == sha("\nx\nassistant\n\n") and found[None].loss_chars == 1
    assert found[4].turns_sha256 == sha("x: y:\n\nx: y:\n\n")
    assert chat.read_back(chat.examples(rows.limit(0))).count() == 0
    stray = spark.range(400).select(F.lit(None).cast("bigint").alias("conv_id"), F.lit(0).alias("turn"), F.lit("assistant").alias("role"), F.lit("x" * 50).alias("text"))
    records = chat.examples(stray)
    assert records.count() == 400 and records.agg(F.max(F.length("formatted"))).first()[0] < 100
    back = chat.read_back(records)
    assert back.count() == 400 and back.where("n_turns = 1 AND loss_chars = 50").count() == 400


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = [(r.doc_id, r.text) for r in docs.collect()]
    kept = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    want = [i for i, _, first in brute.near_duplicates(before, 5, 80) if i == first]
    assert sorted(r.doc_id for r in kept.collect()) == want and kept.columns == docs.columns
    clean = corpus_pipeline.decontamination(spark, docs, SMALL)
    con = oracle_check.connect(SMALL)
    want = con.sql(f"SELECT doc_id FROM ({queries.SQL['op4_winnowing_decontamination']}) WHERE NOT contaminated ORDER BY 1").fetchall()
    assert sorted(r.doc_id for r in clean.collect()) == [w[0] for w in want]
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == [*docs.columns, "mix_slot", "mix_place"] and 0 < out.count() < len(before)
