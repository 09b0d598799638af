"""Phrases, language and ranked search against plain versions, and on odd tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from charlake.llm import language, phrases, ranking
from charlake.llm.registry import QUERIES, ship
from tests.llm.rows import EXTRA, documents, empty, odd_documents, prose

CLASH = EXTRA + ", f long, w1 string, flags int, item int, _item long, terms string, rank int, lang_pred string, luck long, slice string, place int, level long, held_out int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def odd(spark):
    return odd_documents(spark).cache()


def clashing(spark, rows):
    """doc_id, text, lang with every other column an internal name."""
    width = len(CLASH.split(",")) - 3
    return spark.createDataFrame([(i, t, lang, *[None] * width) for i, t, lang in rows], CLASH)


# Phrases


def plain_phrases(rows, least, top, covered):
    """Every phrase of two and three words, counted and scored one by one."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lower):
            ws = re.findall(r"[^ \t]+", piece)
            for size in (1, 2, 3):
                counts[lang or "und"].update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
    out = []
    for lang, c in counts.items():
        n, found = sum(v for p, v in c.items() if len(p) == 1), []
        for p, a in c.items():
            if len(p) == 1 or a < least:
                continue
            if any(len(q) > len(p) and f >= least and 100 * f >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, f in c.items()):
                continue
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def phrase_rows(docs):
    return sorted(map(tuple, phrases.mined(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("size", [10**6, 400])
def test_phrases_against_all_counts(spark, monkeypatch, size):
    """Several rounds, slices of few bytes, a full flag table, several languages."""
    for name, value in (("LEAST", 3), ("TOP", 25), ("FIRST_RANK", 10), ("NEXT_RANK", 2), ("SLICE", size), ("LEAST_SLOTS", 64), ("MOST_SLOTS", 64)):
        monkeypatch.setattr(phrases, name, value)
    fixed = "New York City, new york city. NEW york! old\tYork  city\x0bé É é É é É é É"
    rows = [(i, f"{prose(i % 7, 150)} {fixed if i % 3 else ''} {'a b ' * (i % 5)}", ("en", "de", None)[i % 3]) for i in range(40)]
    assert phrase_rows(clashing(spark, rows)) == plain_phrases([(r[2], r[1]) for r in rows], 3, 25, phrases.COVERED)


def test_phrases_hot_rows_and_large_counts(spark):
    """A third of the rows one text; the score of large counts is exact."""
    rows = [(i, "hot words here" if i % 3 == 0 else f"u{i} hot v{i} words", "en") for i in range(600)]
    assert phrase_rows(clashing(spark, rows)) == plain_phrases([(r[2], r[1]) for r in rows], phrases.LEAST, phrases.TOP, phrases.COVERED)
    big = spark.createDataFrame([(10**13 + 7, 3 * 10**13 + 1, 10**13 + 9)], "a long, l long, r long")
    got = big.select(phrases._score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 10**6 * (10**13 + 7) ** 2 // ((3 * 10**13 + 1) * (10**13 + 9))


def test_phrases_of_odd_tables(spark, odd):
    got = phrase_rows(odd)
    assert got == plain_phrases([(r["lang"], r["text"]) for r in odd.collect()], phrases.LEAST, phrases.TOP, phrases.COVERED)
    assert phrase_rows(empty(spark)) == [] and phrase_rows(documents(spark, [None, "", " \t"])) == []


def test_a_long_text_is_cut_at_piece_ends(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 50)
    text = b"one two three. " * 30 + b"x" * 200 + b" y z"
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([b"en"]), pa.array([text])], ["lang", "text"])
    parts = [t for _, ts in phrases._slices(iter([batch])) for t in ts]
    assert len(parts) > 5 and b"".join(parts) == text.replace(b".", b"\xff") and all(p.endswith(b"\xff") for p in parts[:-1])


# Language


def test_language_against_plain_compression(spark):
    """Every text with every dictionary by itself; the model is the same wherever the rows lie."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.learn(docs)
    assert model == language.learn(docs.repartition(7)) and set(model) == {"en", "de", "fr", "es"}
    got = {r["doc_id"]: r for r in language.predicted(docs, model).collect()}
    import zstandard as z

    for row in docs.collect():
        body = " ".join(re.findall(r"[^\W\d_]+", row["text"].lower())).encode()
        seen = {}
        for lang, content in model.items():
            p = z.ZstdCompressionParameters.from_level(6, source_size=8192, dict_size=len(content), strategy=z.STRATEGY_LAZY, min_match=4, search_log=2, write_content_size=False, write_checksum=False, write_dict_id=False)
            tool = z.ZstdCompressor(compression_params=p, dict_data=z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT))
            seen[lang] = sum(len(tool.compress(body[i : i + 8192])) for i in range(0, len(body), 8192))
        mine = got[row["doc_id"]]
        assert mine["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert seen[mine["lang_pred"]] == min(seen.values()) or mine["lang_pred"] == "und", (row["doc_id"], seen)
        if mine["lang_pred"] != "und":
            assert math.isclose(mine["score"], 1 / sum(2.0 ** (min(seen.values()) - s) for s in seen.values()))


@pytest.mark.parametrize("sf,least", [("sf0.001", 0.95), ("sf0.01", 0.98)])
def test_language_of_held_out_rows(spark, sf, least):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op12_language"](spark, f"/root/testdata/{sf}").join(docs, "doc_id").where("held_out")
    right, rejected = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.avg(F.col("rejected").cast("double"))).first()
    assert right >= least and rejected < 0.05


def test_language_of_odd_tables(spark, odd):
    model = language.learn(odd)
    rows = [(1, None), (2, "123 !?"), (3, ""), (None, prose(1, 50)), (4, prose(2, 30_000)), (4, prose(2, 30_000))]
    found = language.predicted(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    by = {r["doc_id"]: r for r in found}
    assert len(found) == 6 and all((by[i]["lang_pred"], by[i]["score"], by[i]["rejected"]) == ("und", 0.0, True) for i in (1, 2, 3))
    assert by[None]["held_out"] is False and by[4]["lang_pred"] == "en" and 0 <= by[4]["score"] <= 1
    assert language.learn(empty(spark)) == {} and language.predicted(empty(spark), {}).count() == 0
    assert {r["lang_pred"] for r in language.predicted(odd, {}).collect()} == {"und"}


def test_language_learns_only_from_its_rows_and_each_text_once(spark):
    """Held-out rows, rows without lang or id and copies change nothing."""
    rows = [(i, prose(i, 40), "en") for i in range(60)]
    more = [(i, "held out words only", "xx") for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    more += [(None, "no id", "yy"), (5, "no lang", None)] + [(1_000 + i, rows[0][1], "en") for i in range(300)]
    got = language.learn(clashing(spark, rows + more))
    assert set(got) == {"en"} and got == language.learn(clashing(spark, [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1] + more[-1:]))
    assert got["en"].count(prose(0, 40).lower()[:9].encode()) <= 2


# Ranked search


def plain_ranks(docs, items, top):
    """Every document's score with every item."""
    cut = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    found = [(i, Counter(cut.findall(lower(t)))) for i, t in docs]
    n_docs, n_all = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        want = Counter(cut.findall(lower(text)))
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in want}
        scores = []
        for doc, c in found:
            m = 75 + 25 * sum(c.values()) * n_docs // max(n_all, 1)
            s = sum(k * weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in want.items() if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, r + 1, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def rank_rows(docs, items, **more):
    return sorted(map(tuple, ranking.ranked(docs, items, **more).select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("block,item_chars", [(8_192, 10**6), (64, 300)])
def test_ranks_against_all_scores(spark, monkeypatch, block, item_chars):
    """One tree and many, items in one block and several, ties, copies, repeated ids."""
    monkeypatch.setattr(ranking, "BLOCK_ROWS", block)
    monkeypatch.setattr(ranking, "ITEM_CHARS", item_chars)
    docs = [(i, prose(i % 170, 5 + i % 90), "en") for i in range(500)] + [(7, prose(3, 40), "en")] * 3 + [(i, "équipe été alpha9", None) for i in range(500, 560)]
    items = [(i, prose(i * 11, 12) + (" ÉTÉ équipe Équipe" if i % 4 == 0 else "")) for i in range(9)]
    got = rank_rows(clashing(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert got == plain_ranks([(d[0], d[1]) for d in docs], items, ranking.TOP)
    assert rank_rows(clashing(spark, docs), spark.createDataFrame(items, "item_id long, text string"), top=3) == plain_ranks([(d[0], d[1]) for d in docs], items, 3)


def test_ranks_of_odd_tables(spark, odd):
    items = [(1, None), (2, ""), (None, "One two"), (4, "nowhere"), (5, prose(1, 8)), (5, prose(2, 8)), (6, prose(3, 2_000))]
    frame = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    assert rank_rows(odd, frame) == plain_ranks([(r["doc_id"], r["text"]) for r in odd.collect()], items, ranking.TOP)
    assert rank_rows(empty(spark), frame) == [] and rank_rows(odd, frame.limit(0)) == []


def test_bounds_hold_and_prune():
    """No row below a node scores above its bound, and a search for one of many clusters leaves most rows alone."""
    luck = np.random.default_rng(3)
    sizes, terms, values = [], [], []
    for i in range(1_000):
        own = np.unique(luck.integers(i % 20 * 50, i % 20 * 50 + 50, 30))
        sizes.append(len(own))
        terms.append(own)
        values.append(luck.integers(400_000, 450_000, len(own)))
    ends, terms, values = np.append(0, np.cumsum(sizes)), np.concatenate(terms), np.concatenate(values)
    root = np.sqrt(luck.integers(1, 9_000, 1_000).astype(float))
    tree = ranking.BallTree(ends, terms, values, root)
    vector, scaled = np.zeros(1_000, np.int64), np.zeros(1_000)
    its = np.arange(100, 130)
    vector[its] = luck.integers(1, 9_000, 30)
    scaled[its] = vector[its] / root[its]
    exact = np.add.reduceat(values * vector[terms], ends[:-1])
    norm = math.sqrt(float(scaled @ scaled))

    def rows_of(node):
        below = tree.below[node]
        return tree.rows[node] if below is None else np.concatenate([rows_of(b) for b in below])

    assert all(tree.bound(n, scaled, norm) >= exact[rows_of(n)].max() for n in range(len(tree.centre)))
    walk, seen, best = tree.search(vector, scaled, 1), 0, []
    try:
        rows, scores = next(walk)
        while True:
            seen += len(rows)
            best = sorted([*best, *scores.tolist()], reverse=True)[:20]
            rows, scores = walk.send(best[-1] if len(best) == 20 else 1)
    except StopIteration:
        pass
    assert best == sorted(exact.tolist(), reverse=True)[:20] and seen < 500


@pytest.mark.parametrize("name", ["op11_phrases", "op12_language", "op13_ball_tree"])
def test_schema(spark, name):
    want = {
        "op11_phrases": "lang string, rank int, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
        "op12_language": "doc_id bigint, held_out boolean, lang_pred string, score double, margin double, rejected boolean",
        "op13_ball_tree": "item_id bigint, rank int, doc_id bigint, score bigint",
    }
    assert ", ".join(f"{c} {t}" for c, t in QUERIES[name](spark, "/root/testdata/sf0.001").dtypes) == want[name]
