"""The operators against plain versions, and on odd tables."""

import base64
import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from charlake.llm import decontamination as dec, fuzzy_lines as fz, ngram_join as nj, packing as pk, pii, quality as ql, sharding as sh, toxicity as tx, warc
from charlake.llm.common import components, slices, whole_groups
from charlake.llm.registry import ship
from charlake.llm import tokens
from charlake.llm.token_files import read_documents, read_tokens, task_number, write_tokens
from charlake.llm.tokens import Encoder, vocabulary
from charlake.operators.scratch import scratch_root
from tests.llm.rows import INNER, documents, empty, odd_documents, prose


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def odd(spark):
    return odd_documents(spark).cache()


# Personal data


def spans(spark, text):
    return spark.createDataFrame([(1, text)], "doc_id long, text string").transform(pii.pii_report).first()


def test_pii_base_kinds(spark):
    text = "é a.b@c.d-e.org 1.2.3.4 999.1.1.1 4111 1111 1111 1111 4111111111111112 +1 (555) 010-9999 +12"
    got = spans(spark, text)
    want = [f"{k}:{text.index(v)}:{text.index(v) + len(v)}" for k, v in (("email", "a.b@c.d-e.org"), ("ip", "1.2.3.4"), ("phone", "+1 (555) 010-9999"))]
    # Digits with single blanks between them are one match: it is too long, dropped and not tried again.
    assert got["spans"].split(",") == want and (got["n_email"], got["n_ip"], got["n_card"], got["n_phone"]) == (1, 1, 0, 1)
    assert spans(spark, "card 4111-1111-1111-1111.")["n_card"] == 1 and spans(spark, "card 4111-1111-1111-1112.")["n_card"] == 0


def test_pii_further_kinds_need_checksum_or_context(spark):
    assert spans(spark, "pay to GB82 WEST 1234 5698 7654 32 now")["spans"] == "iban:7:34"
    assert spans(spark, "pay to GB83 WEST 1234 5698 7654 32 now")["spans"] == ""
    assert spans(spark, "SSN 123-45-6789")["spans"] == "ssn:4:15" and spans(spark, "part 123-45-6789")["spans"] == ""
    assert spans(spark, "call 555-123-4567")["spans"] == "local_phone:5:17"
    assert spans(spark, "call +1 555-123-4567")["spans"].startswith("phone:") and "local" not in spans(spark, "call +1 555-123-4567")["spans"]


def test_pii_adjoining_and_long(spark):
    assert spans(spark, "a@b.c%d@e.f")["spans"] == "email:0:5,email:5:11"
    assert spans(spark, "a" * 200_000)["spans"] == "" and spans(spark, "1" * 200_000)["spans"] == ""
    many = " ".join(["x@y.zz"] * 2_000)
    assert spans(spark, many)["n_email"] == 2_000


def test_pii_mask(spark):
    row = spark.createDataFrame([(1, "mail x@y.zz or 1.2.3.4!")], "doc_id long, text string").transform(pii.masked).first()
    assert row["text"] == "mail <email> or <ip>!"


def test_pii_odd(spark, odd):
    report = pii.pii_report(odd)
    assert report.count() == odd.count() and report.where("doc_id IS NULL").count() == 2
    assert report.where("doc_id = 0").first()["spans"] == "" and report.where("doc_id = 4").count() == 3
    assert pii.pii_report(empty(spark)).count() == 0 and pii.masked(empty(spark)).columns == empty(spark).columns
    docs = spark.createDataFrame([(1, "mail x@y.zz, SSN 123-45-6789", 5, 6)], "doc_id long, text string, _more long, _MORE_ long")
    row = pii.masked(docs).first()
    assert row.asDict() == {"doc_id": 1, "text": "mail <email>, SSN <ssn>", "_more": 5, "_MORE_": 6}


# Shards


def test_shards_are_even_and_gapless(spark):
    luck = random.Random(3)
    docs = documents(spark, ["w" * luck.choice([1, 10, 100, 2_000]) for _ in range(3_000)])
    rows = sh.shard_by_bytes(docs).toPandas()
    sizes = rows.groupby("shard")["size"].sum()
    assert len(rows) == 3_000 and sizes.max() - sizes.min() <= 2 * 2_001 and set(rows["law"]) == {"bytes"}
    for _, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_shards_of_one_hot_key(spark, monkeypatch):
    monkeypatch.setattr(sh, "ROWS_PER_RANGE", 50)
    monkeypatch.setattr(sh, "MIN_RANGES", 4)
    docs = spark.range(1_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    ranges = sh.ranged(sh.keyed(docs)).groupBy("_range").count().toPandas()
    assert ranges["count"].max() <= 200
    rows = sh.shard_by_bytes(docs).toPandas()
    assert rows.groupby("shard").size().tolist() == [125] * 8


def test_shards_odd(spark, odd):
    rows = sh.shard_by_bytes(odd).toPandas()
    assert len(rows) == odd.count() and rows["size"].min() == 1 and rows[rows["size"] == 1]["text_crc32"].eq(0).all()
    assert sh.shard_by_bytes(empty(spark)).count() == 0


# Decontamination


def infix_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row), row.index(min(row))


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=70), st.text("abc", max_size=90))
def test_myers(pattern, text):
    assert dec.myers(pattern, text) == infix_distance(pattern, text)


def test_every_passage_within_the_budget_is_found(spark):
    luck = random.Random(5)
    items = [prose(100 + i, 12 + i) for i in range(12)]
    texts = []
    for item in items:
        changed = list(item)
        for _ in range(luck.randint(0, 12)):
            changed[luck.randrange(len(changed))] = luck.choice("abxyz .")
        texts.append(prose(len(texts), 80) + "".join(changed) + prose(len(texts) + 50, 80))
    bench = spark.createDataFrame([*enumerate(items), (98, None), (99, "too short")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in dec.contaminated(documents(spark, texts), bench).collect()}
    want = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(map(dec.normal, items)):
            distance, _ = infix_distance(item, dec.normal(text))
            if distance <= dec.budget(len(item)):
                want[d, i] = distance
    assert got == want and len(want) >= 4


def test_where_an_item_is(spark):
    text = "Before it. " + prose(7, 20).upper() + " after"
    row = dec.contaminated(documents(spark, [text]), spark.createDataFrame([(5, prose(7, 20))], "item_id long, text string")).first()
    assert text[row["start"] : row["end"]] + "." == prose(7, 20).upper() and row["distance"] == 0


def test_items_in_several_blocks(spark, monkeypatch):
    bench = spark.createDataFrame([(i, prose(i, 15)) for i in range(6)], "item_id long, text string")
    docs = documents(spark, [prose(3, 15), prose(5, 15) + " and more"])
    one = sorted(map(tuple, dec.contaminated(docs, bench).collect()))
    monkeypatch.setattr(dec, "BLOCK_CHARS", 100)
    assert sorted(map(tuple, dec.contaminated(docs, bench).collect())) == one and len(one) == 2


def test_short_items_are_found_as_whole_words(spark):
    bench = spark.createDataFrame([(1, "Red fox!"), (2, "..."), (3, "fox")], "item_id long, text string")
    docs = documents(spark, ["a red  FOX ran", "a red foxes ran", "fox", "bored fox", "redfox"])
    got = sorted((r["doc_id"], r["item_id"], r["distance"], r["start"], r["end"]) for r in dec.contaminated(docs, bench).collect())
    assert got == [(0, 1, 0, 2, 10), (0, 3, 0, 7, 10), (2, 3, 0, 0, 3), (3, 3, 0, 6, 9)]


def test_decontamination_odd(spark, odd):
    bench = spark.createDataFrame([(None, prose(2, 60)), (1, None)], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in dec.contaminated(odd, bench).collect()] == [(6, None)]
    assert dec.clean_of(odd, bench).count() == odd.count() - 1 and dec.clean_of(odd, bench).columns == odd.columns
    assert dec.contaminated(odd, bench.where("false")).count() == 0 and dec.clean_of(empty(spark), bench).count() == 0


# Packing


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 3), st.integers(0, 20)), max_size=60))
def test_pack_vectors_keeps_all_limits(demands):
    limits = np.array([50, 3, 20])
    bins = pk.pack_vectors(np.array(demands, np.int64).reshape(-1, 3), limits)
    for b in set(bins.tolist()):
        assert (np.array(demands)[bins == b].sum(axis=0) <= limits).all()
    assert sorted(set(bins.tolist())) == list(range(len(set(bins.tolist()))))


def test_pack_vectors_refuses_what_fits_nowhere():
    with pytest.raises(ValueError):
        pk.pack_vectors(np.array([[51, 1, 1]]), [50, 3, 20])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.just(1), st.integers(0, 20)), min_size=1, max_size=40))
def test_pack_vectors_against_a_plain_packer(demands):
    limits, n = [50, 6, 20], len(demands)
    weights = [sum(d[k] / limits[k] for d in demands) / n for k in range(3)]
    left, bins, now = list(range(n)), {}, 0
    while left:
        rest = list(limits)
        while fits := [i for i in left if all(demands[i][k] <= rest[k] for k in range(3))]:
            pull = {i: sum(demands[i][k] / limits[k] * weights[k] * rest[k] / limits[k] for k in range(3)) for i in fits}
            best = next(i for i in fits if pull[i] >= max(pull.values()) - 1e-12)
            bins[best] = now
            left.remove(best)
            rest = [r - d for r, d in zip(rest, demands[best], strict=True)]
        now += 1
    mine = pk.pack_vectors(np.array(demands), limits)
    # The order inside a sequence may differ where pulls are equal but for rounding, not how full sequences are.
    assert abs(int(mine.max()) + 1 - now) <= 1 and sorted(bins) == list(range(n))


def test_little_padding(spark):
    luck = random.Random(8)
    rows = spark.createDataFrame([(i, luck.randint(1, 900)) for i in range(3_000)], "doc_id long, tokens long")
    packed = pk.pack(rows, {"tokens": 2_048}).toPandas()
    assert packed["tokens"].sum() / (packed["sequence_id"].nunique() * 2_048) > 0.98


def test_dot_product_mixes_demands():
    # Half want tokens, half want loss; a packing by tokens alone would need more sequences.
    demands = np.array([[40, 1, 2]] * 20 + [[10, 1, 18]] * 20)
    assert pk.pack_vectors(demands, [50, 8, 20]).max() + 1 == 20


def test_packing_by_segments(spark):
    rows = spark.range(100).select(F.col("id").alias("doc_id"), F.lit(10).alias("tokens"), F.lit(1).alias("segments"))
    packed = pk.pack(rows, {"tokens": 100, "segments": 4}, block_rows=1_000).toPandas()
    assert packed.groupby("sequence_id").size().tolist() == [4] * 25 and sorted(packed["offset"].unique()) == [0, 10, 20, 30]


def plain_ids(text, name, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(name))
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_packed_pieces_hold_every_id_once(spark, odd):
    rows = pk.pack_documents(odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), vocabulary("word_bpe_49k.json")).toPandas()
    texts = {r["doc_id"]: r["text"] for r in odd.where("doc_id IS NOT NULL").collect()}
    for doc_id, text in texts.items():
        ids, at = plain_ids(text, "word_bpe_49k.json", 1), 0
        for piece in rows[rows["doc_id"] == doc_id].sort_values("start").itertuples():
            part = ids[piece.start : piece.start + piece.length]
            assert piece.start == at and piece.doc_tokens == len(ids) and piece.ids_crc32 == zlib.crc32(part.tobytes())
            at += piece.length
        assert at == len(ids)
    for _, part in rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert (part["length"].cumsum() - part["length"]).tolist() == part["offset"].tolist() and part["length"].sum() <= 2_048
    assert pk.pack_documents(odd, vocabulary("word_bpe_49k.json")).where("start = 0").count() == odd.count()
    assert pk.pack_documents(empty(spark), vocabulary("word_bpe_49k.json")).count() == 0


# Fuzzy lines


def line_sets(text):
    out = {}
    for no, line in enumerate((text or "").split("\n")):
        line = line.strip(" \t\r")
        if line:
            out[no] = line, {line[i : i + fz.CHARS] for i in range(max(len(line) - fz.CHARS, 0) + 1)}
    return out


def test_fuzzy_lines_against_all_pairs(spark):
    luck = random.Random(9)
    base = [prose(i, 25) for i in range(12)]
    texts = []
    for d in range(60):
        lines = []
        for _ in range(3):
            words = luck.choice(base).split()
            for _ in range(luck.choice([0, 0, 1, 2, 6])):
                words[luck.randrange(len(words))] = luck.choice("changed other thing".split())
            lines.append(" ".join(words))
        texts.append("\n".join([*lines, "short", ""]))
    places = {(d, no): v for d, t in enumerate(texts) for no, v in line_sets(t).items()}
    keys, up = sorted(places), {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = places[a][1], places[b][1]
            if len(x & y) / len(x | y) >= fz.SIMILARITY:
                p, q = sorted((top(a), top(b)))
                up[q] = p
    want = {d: ",".join(str(no) for (e, no) in keys if e == d and top((e, no)) != (e, no)) for d in range(60)}
    rows = fz.line_report(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["removed"] for r in rows} == want and sum(r["n_removed"] for r in rows) > 60
    kept = {r["doc_id"]: r["text"] for r in fz.without_fuzzy_lines(documents(spark, texts)).collect()}
    for d, text in enumerate(texts):
        gone = set(want[d].split(","))
        left = "\n".join(line for no, line in enumerate(text.split("\n")) if str(no) not in gone)
        assert kept.get(d, "") in (left, "")


def test_fuzzy_lines_delete_superseded_tables(spark):
    before = set(os.listdir(scratch_root(spark)))
    lines = [prose(i, 25) for i in range(4)]
    texts = [line.replace(" ", f" {i}", 1) for line in lines for i in range(5)] + lines
    kept = fz.without_fuzzy_lines(documents(spark, texts))
    left = Counter(name.rsplit("-", 1)[0] for name in set(os.listdir(scratch_root(spark))) - before)
    gone = {f"line-{name}" for name in "signatures entries buckets texts pairs near leads links".split()}
    assert not gone & left.keys() and left["lines"] == 2 and left["line-docs"] == 1
    assert kept.count() == 4


def test_fuzzy_lines_compare_a_pair_in_one_bucket(spark):
    """Two lines that share buckets 1 and 2 are compared in bucket 1 only: what its first line rules out is not counted again in 2."""
    lines = {h: prose(3, 20) + f" {h}" for h in (10, 11, 12)}
    texts = spark.createDataFrame(list(lines.items()), "h long, line string")

    def found(js):
        rows = [(key, 5, h, 100, j[h], h, True) for key, j in js.items() for h in j]
        return sorted(map(tuple, fz._other_links(spark.createDataFrame(rows, "key long, first long, h long, n int, j double, root long, apart boolean"), texts).collect()))

    apart, near = {10: 0.1, 11: 0.7}, {10: 0.5, 11: 0.6}
    assert found({1: apart, 2: near}) == [] and found({1: near, 2: apart}) == [(10, 11)]
    assert found({1: near, 2: near | {12: 0.5}}) == [(10, 11), (10, 12), (11, 12)]


def test_fuzzy_lines_whose_sizes_are_not_near(spark):
    """Longer and longer lines share buckets with ones that they cannot be linked to, and links among the others are found."""
    whole = prose(7, 60)
    lines = [whole[: 60 + 20 * i] for i in range(16)]
    lines += [line[:-9] + "?!" for line in lines]
    sets = [s for _, s in line_sets("\n".join(lines)).values()]
    group = list(range(len(lines)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if len(x & y) / len(x | y) >= fz.SIMILARITY:
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    rows = fz.line_report(documents(spark, lines)).collect()
    assert {r["doc_id"] for r in rows if r["n_removed"]} == {i for i, g in enumerate(group) if g != i} and 1 < len(set(group)) < len(lines)


def test_no_similarity_is_worked_out_for_sizes_that_are_not_near(spark, monkeypatch):
    asked, compared = [], fz._compared

    def noted(pairs, texts):
        asked.append(pairs.count())
        return compared(pairs, texts)

    monkeypatch.setattr(fz, "_compared", noted)
    # All hashes of the shorter line are in the longer one: 22 and 29 shingles, with a run of four in common.
    short = "abcdefghijklmnopqrstuvwxyz"
    assert fz.line_report(documents(spark, [short, short + "0123456"])).where("n_removed > 0").isEmpty()
    shared = fz.signatures(spark.createDataFrame([(1, short), (2, short + "0123456")], "h long, line string"))
    assert shared.select(F.explode("bands").alias("key")).groupBy("key").count().where("count > 1").count() > 0
    assert asked == [0]


def lines_of_a_family(n, changed):
    """A line n times, each with so many of its words replaced by ones of its own."""
    luck, out = random.Random(3), []
    for i in range(n):
        words = prose(11, 60).split()
        for at in luck.sample(range(60), changed):
            words[at] = f"{luck.randrange(10**8):08d}"
        out.append(" ".join(words))
    return out


def test_bits_rule_out_far_lines_only(spark):
    """No pair of 0.8 or more is ruled out, whatever the lines, and pairs that are far below are."""
    luck = random.Random(8)
    lines = [line for changed in (2, 4, 6, 12) for line in lines_of_a_family(12, changed)] + ["abcd" * 60, "abcd" * 600, "", "a", "今日は良い天気です。", "x" * 30_000]
    lines += ["".join(luck.choices("abcdefgh ", k=9_000)) + "#" * luck.randint(0, 2_000) for _ in range(4)]
    sets = [{line[i : i + fz.CHARS] for i in range(max(len(line) - fz.CHARS, 0) + 1)} for line in lines]
    marks = fz._marks(spark.createDataFrame([*enumerate(lines)], "h long, line string"))
    pairs = [(a, b, len(sets[a]) + len(sets[b])) for b in range(len(lines)) for a in range(b)]
    kept = {tuple(r) for r in fz._hopeful(spark.createDataFrame(pairs, "a long, b long, total long"), marks).collect()}
    j = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b, _ in pairs}
    assert {p for p in j if j[p] >= fz.SIMILARITY} <= kept and sum(j[p] >= fz.SIMILARITY for p in j) > 20
    far = [p for p in j if j[p] < 0.65 and max(map(len, (sets[p[0]], sets[p[1]]))) < 700]
    assert len(far) > 300 and not kept & set(far)


def test_elections_compare_no_far_lines(spark, monkeypatch):
    """Of a family whose lines are all far from each other but share buckets, next to none are compared but with a bucket's first line."""
    asked, compared = [], fz._compared

    def noted(pairs, texts):
        asked.append(pairs.count())
        return compared(pairs, texts)

    monkeypatch.setattr(fz, "_compared", noted)
    lines = lines_of_a_family(60, 8)
    assert fz.line_report(documents(spark, lines)).where("n_removed > 0").isEmpty()
    assert len(asked) > 1 and sum(asked[1:]) * 20 < asked[0]


def test_lines_alike_by_chance_share_few_bands(spark):
    """Of a million pairs with a similarity of about 0.06, next to none become candidates, as their number grows with the square of the lines."""
    luck = random.Random(5)
    lines = [(i, "".join(luck.choices("abcd", k=130))) for i in range(1_500)]
    keys = fz.signatures(spark.createDataFrame(lines, "h long, line string").repartition(2)).select("h", F.explode("bands").alias("key"))
    assert keys.groupBy("key").agg(F.count_distinct("h").alias("n")).where("n > 1").count() < 8


def test_near_lines_of_any_length_share_a_band(spark):
    luck = random.Random(6)
    pairs = []
    for i in range(600):
        line = "".join(luck.choices("abcdefghijklmnopqrstuvwxyz", k=luck.randint(5, 110)))
        pairs.append((2 * i, line))
        # A quarter more shingles at the end leave a similarity of 0.8 or more.
        n = max(len(line) - 4, 1)
        pairs.append((2 * i + 1, line + "".join(luck.choices("0123456789", k=n // 4)) if len(line) >= 9 else line))
    keys = fz.signatures(spark.createDataFrame(pairs, "h long, line string").repartition(2)).select("h", F.explode("bands").alias("key"))
    found = keys.groupBy("key", F.floor(F.col("h") / 2).alias("pair")).agg(F.count_distinct("h").alias("n")).where("n > 1").select("pair").distinct().count()
    assert found >= 599


def test_fuzzy_lines_odd(spark, odd):
    report = fz.line_report(odd)
    assert report.count() == odd.count()
    rows = {r["doc_id"]: r for r in report.where("doc_id IS NOT NULL").collect()}
    assert rows[5]["removed"] == "0" and rows[5]["groups"] == "0=4:0" and rows[9]["n_removed"] == 4 and rows[7]["n_removed"] == 0
    kept = fz.without_fuzzy_lines(odd)
    assert kept.columns == odd.columns and not {5} & {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert fz.line_report(empty(spark)).count() == 0 and fz.without_fuzzy_lines(empty(spark)).count() == 0


def test_blankless_lines_differ(spark):
    # They begin alike and have no blank: only shingles inside long words tell them apart.
    texts = ["https://example.com/" + "".join(random.Random(i).choices("abcdef", k=80)) for i in range(20)]
    assert fz.line_report(documents(spark, texts)).where("n_removed > 0").count() == 0


# Quality


def test_line_rules():
    fails = {
        "no mark at all in this line": True, "Home | News | Shop | About.": True, "a### b$$$ c%%% d.": True, "WHAT!! IS!! THIS!!": True,
        "ALL OF THIS IS SHOUTED.": True, "so so so so so so.": True, "All rights reserved.": True,
        "A plain sentence, as it should be.": False, "It costs $5, I said!": False,
    }
    assert {line: ql.line_fails(line, line.encode().split()) for line in fails} == fails


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=30), max_size=6))
def test_repeated_words(texts):
    want = []
    for words in texts:
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        want.append(len({p for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}))
    assert ql.repeated_words(texts).tolist() == want


def test_quality_odd(spark, odd):
    rows = ql.with_quality(odd.select("doc_id", "text")).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert not by_id[0]["kept"] and by_id[0]["n_words"] == 0 and by_id[4]["kept"] and by_id[9]["n_dup_lines"] == 4 and by_id[8]["kept"]
    kept = ql.clean_documents(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 8, None}
    big = spark.createDataFrame([((1 << 60) + 1, prose(1, 30)), (None, prose(2, 30))], "doc_id long, text string")
    assert (1 << 60) + 1 in {r["doc_id"] for r in ql.clean_documents(big).collect()}
    assert ql.clean_documents(empty(spark)).count() == 0


def test_cleaned_text_has_no_failing_line(spark):
    text = "\n".join([prose(1, 20), "", "Home | News | Shop", prose(2, 20)])
    row = ql.clean_documents(documents(spark, [text])).first()
    assert row["text"] == "\n".join([prose(1, 20), "", prose(2, 20)]) and row["n_chars"] == len(row["text"])


# Toxicity


def run_grammar(symbols):
    state, out = tx.GRAMMAR.start, []
    for s in symbols:
        state, emitted = tx.GRAMMAR.step(state, s)
        out.append("".join(sorted(emitted)))
    return out


def test_grammar_scopes():
    assert run_grammar("I") == ["i"] and run_grammar("TI") == ["", "it"]
    assert run_grammar("N*I")[-1] == "in" and run_grammar("N***I")[-1] == "i"
    assert run_grammar("R*H")[-1] == "hr" and run_grammar("RNI")[-1] == "inr"


def test_toxicity_learns_and_keeps_labels_apart(spark):
    luck = random.Random(4)
    texts, labels = [], []
    for i in range(1_200):
        bad = luck.random() < 0.3
        words = prose(i, 40).split()
        if bad:
            for _ in range(2):
                words.insert(luck.randrange(len(words)), luck.choice(["zorgan", "zorgaten", "blurtish"]))
        texts.append(" ".join(words))
        labels.append((i, int(bad)))
    docs = documents(spark, [*texts, None, ""])
    rows = tx.score_documents(docs, tx.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))).toPandas().set_index("doc_id")
    assert len(rows) == 1_202 and rows["score"].between(0, 1).all() and rows["score"].notna().all()
    want = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(1_202)}
    assert rows["held_out"].to_dict() == want
    held = [(i, y) for i, y in labels if want[i]]
    assert sum(rows.loc[i, "predicted"] == y for i, y in held) / len(held) > 0.97
    # Labels of held-out rows change nothing.
    turned = spark.createDataFrame([(i, 1 - y if want[i] else y) for i, y in labels], "doc_id long, toxic int")
    again = tx.score_documents(docs, tx.learn(docs, turned)).toPandas().set_index("doc_id")
    assert np.allclose(again["score"].sort_index(), rows["score"].sort_index())


def test_toxicity_odd(spark, odd):
    labels = spark.createDataFrame([(4, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    rows = tx.score_documents(odd, tx.learn(odd, labels)).toPandas()
    assert len(rows) == odd.count() and rows["score"].eq(0).all()
    assert tx.score_documents(empty(spark), tx.learn(empty(spark), labels)).count() == 0


# Similarity join


def grams(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_join_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(nj, "BUCKET_BLOCK", 8)
    monkeypatch.setattr(nj, "GROUP_BLOCK", 8)
    luck = random.Random(6)
    base = [prose(i, 80) for i in range(6)]
    texts = ["", None, "a b", "a b", "  a  b "]
    for _ in range(150):
        words = luck.choice(base).split()
        for _ in range(luck.choice([0, 1, 1, 2, 3])):
            words[luck.randrange(len(words))] = luck.choice("changed other thing".split())
        texts.append(" ".join(words))
    distinct = sorted({t or "" for t in texts})
    sets = {t: grams(t) for t in distinct}
    links = {t: [u for u in distinct if u != t and sets[t] and len(sets[t] & sets[u]) * 5 >= len(sets[t] | sets[u]) * 4] for t in distinct}
    first = {t: min(i for i, u in enumerate(texts) if (u or "") == t) for t in distinct}
    seen = {}
    for t in distinct:
        if t not in seen:
            group, todo = {t}, [t]
            while todo:
                for u in links[todo.pop()]:
                    if u not in group:
                        group.add(u)
                        todo.append(u)
            seen |= dict.fromkeys(group, min(first[u] for u in group))
    rows = {r["doc_id"]: r for r in nj.similar_texts(documents(spark, texts)).collect()}
    assert {i: (r["class_id"], r["n_links"], r["n_copies"]) for i, r in rows.items()} == {
        i: (seen[t or ""], len(links[t or ""]), sum((u or "") == (t or "") for u in texts) - 1) for i, t in enumerate(texts)
    }


def test_join_odd(spark, odd):
    rows = nj.similar_texts(odd)
    assert rows.count() == odd.count()
    kept = nj.one_of_each(odd)
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert kept.columns == odd.columns and ids[4] == 1 and 5 not in ids and ids[0] == 1 and 1 not in ids and ids[None] == 1
    assert nj.similar_texts(empty(spark)).count() == 0 and nj.one_of_each(empty(spark)).count() == 0


def test_one_row_of_each_class_without_ids(spark):
    a, b = prose(1, 80), prose(2, 80)
    near = a.replace("a", "o", 1)
    docs = spark.createDataFrame([(None, a), (None, near), (None, a), (None, b), (3, b), (3, b + " end"), (4, b)], "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in nj.one_of_each(docs).collect()]
    assert len(kept) == 2 and {k for k, _ in kept} == {None, 3}


def test_pruning_bounds():
    least = nj.least_equal()
    assert least[16] < least[96] and least[96] / 96 < nj.THRESHOLD
    assert nj.least_equal(tolerance=0.5)[96] > least[96]


# Archives


def test_archives_round_trip(spark, tmp_path):
    rows = [(1, "http://a/b c\r\nx", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (None, "u", "<p>é</p>"), (5, "u", "x" * 2_000_000), (6, "u", "a\r\n\r\nb")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_archives(pages, f"file://{tmp_path}/archives")
    got = {r["page_id"]: r for r in warc.read_archives(archives).collect()}
    assert len(got) == 7 and got[1]["record_type"] == "revisit" and got[1]["refers_to"] == 2 and got[2]["record_type"] == "response"
    assert got[3]["refers_to"] == 4 and got[4]["payload_bytes"] == 0 and got[None]["refers_to"] == 2 and got[6]["payload"] == b"a\r\n\r\nb"
    for r in got.values():
        if r["payload"] is not None:
            assert r["payload_digest"] == base64.b32encode(hashlib.sha1(bytes(r["payload"])).digest()).decode()
    assert warc.read_archives(warc.write_archives(pages.where("false"), f"file://{tmp_path}/none")).count() == 0


def test_archives_of_repeated_rows_and_clashing_columns(spark, tmp_path):
    body = "<p>" + "x" * 900 + "</p>"
    rows = [(7, "u", body, 1, "s"), (7, "u", body, 2, "t"), (3, None, body, None, None), (1, "u", None, 1, "s")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha1 int, body string")
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}/again")).collect())
    assert got == [(1, "response", None), (3, "revisit", 7), (7, "response", None), (7, "response", None)]


def test_broken_archives_are_refused():
    import io

    good = warc.page_record(1, "u", b"payload", None)
    assert len(list(warc.members(io.BytesIO(good * 3)))) == 3
    with pytest.raises(ValueError, match="inside a member"):
        list(warc.members(io.BytesIO(good[:-5])))
    member = next(warc.members(io.BytesIO(good)))
    for broken in (member.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"), member[:-1], b"no record\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.parsed(broken)


# Token files


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_encoder_gives_the_tokenizers_ids(name, kind):
    coder, luck = Encoder(vocabulary(name), kind), random.Random(1)
    letters = list("ab é  \n\t\r7'sÑ.,1\x1c\x85 ́ß漢字İſ\0") + ["<|endoftext|>"]
    texts = ["".join(luck.choice(letters) for _ in range(luck.randint(0, 40))) for _ in range(3_000)] + [prose(1, 300), ""]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert ids.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_encoder_forgets(monkeypatch, name, kind):
    monkeypatch.setattr(tokens, "REMEMBERED", 60)
    coder, luck = Encoder(vocabulary(name), kind), random.Random(2)
    for _ in range(40):
        texts = [prose(luck.randrange(200), 15) + " the The THE ÄÖ" for _ in range(3)]
        for text, ids in zip(texts, coder.encode(texts), strict=True):
            assert ids.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(coder.codes) < 60 + 3 * 100 and len(coder.starts) == len(coder.lengths) == len(coder.met) == len(coder.codes)


def test_files_follow_by_number(spark):
    names = ["part-100000-a-c000.orc", "part-99999-a-c000.orc", "part-00007-a-c000.orc"]
    rows = spark.createDataFrame([(n,) for n in names], "f string").orderBy(task_number(F.col("f"))).collect()
    assert [r["f"] for r in rows] == names[::-1]


def test_token_files_round_trip(spark, odd, tmp_path):
    folder = str(tmp_path / "tokens")
    write_tokens(odd, folder, vocabulary("byte_bpe_50k.json"), "bytes", 0)
    rows = read_tokens(spark, folder).toPandas()
    assert len(rows) == odd.count()
    texts = {r["doc_id"]: r["text"] for r in odd.where("doc_id IS NOT NULL").collect()}
    for r in rows[rows["doc_id"].notna()].itertuples():
        ids = plain_ids(texts[r.doc_id], "byte_bpe_50k.json", 0)
        assert r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids.tobytes())
    order = rows.sort_values("start")
    assert (order["n_tokens"].cumsum() - order["n_tokens"]).tolist() == order["start"].tolist()
    assert order["doc_id"].dropna().is_monotonic_increasing and order["doc_id"].isna().iloc[:2].all()
    assert read_documents(spark, folder, [8]).first()["ids"] == plain_ids(texts[8], "byte_bpe_50k.json", 0).tolist()
    plan = read_documents(spark, folder, [8])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id, [8])]" in plan or "EqualTo(doc_id,8)" in plan
    none = str(tmp_path / "none")
    write_tokens(empty(spark), none, vocabulary("byte_bpe_50k.json"), "bytes", 0)
    assert read_tokens(spark, none).count() == 0


# Shared helpers


def test_columns_with_inner_names_keep_their_values(spark, odd):
    own = {r["doc_id"]: [r[c] for c in INNER] for r in odd.where("doc_id IS NOT NULL").collect()}
    bench = spark.createDataFrame([(1, prose(2, 60))], "item_id long, text string")
    packed = pk.pack(odd.withColumn("tokens", F.lit(5)), {"tokens": 20})
    results = [fz.without_fuzzy_lines(odd), nj.one_of_each(odd), dec.clean_of(odd, bench), ql.with_quality(odd), ql.clean_documents(odd), pii.with_pii(odd), pii.masked(odd), packed]
    for result in results:
        rows = result.where("doc_id IS NOT NULL").collect()
        assert rows and all([r[c] for c in INNER] == own[r["doc_id"]] for r in rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 150), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(41), 0) | dict.fromkeys((100, 150, 200), 100)


def test_slices_and_whole_groups():
    import pandas as pd

    assert list(slices([3, 3, 9, 1, 1], 5)) == [(0, 1), (1, 2), (2, 3), (3, 5)] and list(slices([])) == []
    frames = [pd.DataFrame({"k": k}) for k in ([1, 1, 2], [2, 2], [2, 3], [], [4])]
    assert [f["k"].tolist() for f in whole_groups(iter(frames), ["k"])] == [[1, 1], [2, 2, 2, 2], [3], [4]]


@pytest.mark.parametrize("name,kind", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "bytes")])
def test_marks_of_the_vocabulary(name, kind):
    """Strings the vocabulary has whole, alone, inside words and between blanks, as an untouched tokenizer gives them."""
    from tokenizers import Tokenizer

    path = vocabulary(name)
    plain, mine = Tokenizer.from_file(path), Encoder(path, kind)
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", "<|endoftext|>", "<|endoftext|>\n<|endoftext|> x", "<|startoftext|> the end", "< |endoftext|>", "<|ENDOFTEXT|>", "the end of text", "a <|endof text|>"]
    for found, text in zip(mine.encode(texts * 2), texts * 2, strict=True):
        assert found.tolist() == plain.encode(text, add_special_tokens=False).ids, text
