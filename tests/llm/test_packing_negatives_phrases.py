"""Packing, hard negatives and phrases: brute force, edge cases, columns with clashing names."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from creascope.llm import hard_negatives, packing, phrases

DOCS = "doc_id long, text string, lang string, start long, chunk string, weight long, sequence_id string"


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(3)
    long = " ".join("".join(rng.choice("abcde ,'") for _ in range(9)) for _ in range(40_000))
    texts = [(1, "Hello, world's end."), (2, None), (3, ""), (4, " \t\n "), (5, long), (6, "x" * 70_000),
             (6, "x" * 70_000), (None, "no id"), (7, "Ünï ço∂é 漢字 😀 <|endoftext|> a"), (8, " " * 300_000),
             (9, "\r\n".join(["a line of words"] * 700))]
    return spark.createDataFrame([(i, t, None, 1, "c", 2, "s") for i, t in texts], DOCS)


# -- packing ----------------------------------------------------------------------------------

def test_packing_round_trip(odd):
    machine = tokenizers.Tokenizer.from_file(packing.VOCABULARY)
    texts = defaultdict(list)
    for r in odd.collect():
        ids = machine.encode(r["text"] or "", add_special_tokens=False).ids
        texts[r["doc_id"]].append(np.array([*ids, 1], "<u4"))
    rows = packing.packed(odd, window=20_000).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        copies = len(texts[doc])
        ids = texts[doc][0]
        for r in pieces:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["doc_tokens"] == len(ids) and len(part) == r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
        covered = np.zeros(len(ids), int)
        for r in pieces:
            covered[r["start"]:r["start"] + r["length"]] += 1
        assert (covered == copies).all()
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert pieces[0]["offset"] == 0
        assert all(a["offset"] + a["length"] == b["offset"] for a, b in pairwise(pieces))
        total = sum(r["length"] for r in pieces)
        assert total == pieces[0]["sequence_capacity"] <= 2048 and total & (total - 1) == 0


def test_packing_of_nothing(spark):
    assert packing.packed(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        packing.packed(spark.createDataFrame([], DOCS), capacity=1000)


def test_packing_balances_cost():
    """Costs of full sequences lie closer together than by first fit over the same descending documents."""
    rng = random.Random(8)
    lengths = [min(900, int(rng.paretovariate(1.1) * 30)) for _ in range(4000)]
    pieces, capacities = packing.pack(lengths)
    spent = Counter()
    for _, _, length, sequence, _ in pieces:
        if capacities[sequence] == packing.CAPACITY:
            spent[sequence] += packing.cost(length)
    left, first_fit = [], []
    for length in sorted(lengths, reverse=True):
        at = next((i for i, room in enumerate(left) if room >= length), len(left))
        if at == len(left):
            left.append(packing.CAPACITY)
            first_fit.append(0)
        left[at] -= length
        first_fit[at] += packing.cost(length)
    full = [c for c, room in zip(first_fit, left) if not room]
    assert np.std(list(spent.values())) < 0.5 * np.std(full)
    assert max(spent.values()) <= max(full)
    assert sum(capacities) == sum(lengths)
    # few documents are cut
    assert len(pieces) < 1.05 * len(lengths)


def test_chunks_keep_the_ids():
    machine = packing.tokens_of(open(packing.VOCABULARY, encoding="utf-8").read())
    rng = random.Random(5)
    text = "".join(rng.choice(["ab", " ", "  ", "\n", "'s", "7", ", ", "é", " ", "　"]) for _ in range(4000))
    whole = machine.fast.encode(text, allowed_special="all")
    for limit in (1, 7, 100):
        parts = [text[a:b] for a, b in packing.safe_chunks(text, limit)]
        assert "".join(parts) == text and len(parts) > 3
        assert [i for p in parts for i in machine.fast.encode(p, allowed_special="all")] == whole


# -- hard negatives ---------------------------------------------------------------------------

def negatives_by_hand(rows, is_anchor, positives=5, negatives=5):
    """All pairs. rows: (id, label, vector) that take part."""
    out, seen = [], set()
    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))
    for i, label, v in sorted(r for r in rows if is_anchor(r[0])):
        if i in seen:
            continue
        seen.add(i)
        ranked = sorted((-dot(v, w), j, other) for j, other, w in rows)
        same = [(j, -s) for s, j, other in ranked if other == label and j != i][:positives]
        for j, score in same:
            fits = [(k, -s) for s, k, other in ranked
                    if other != label and 80 * score <= -100 * s <= 100 * score][:negatives]
            out += [(i, j, rank, k, score, s) for rank, (k, s) in enumerate(fits, 1)]
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r) for r in df.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-60, 60, (12, dims))
    rows = [(i, int(rng.integers(3)), (centres[rng.integers(12)] + rng.integers(-8, 8, dims)).tolist()) for i in range(n)]
    rows += [(n + i, i % 3, rows[5][2]) for i in range(150)]  # a hot vector
    return rows


@pytest.mark.parametrize("leaf_rows, cell", [(4096, 8192), (20, 16), (2, 8192)])
def test_hard_negatives_against_all_pairs(spark, leaf_rows, cell):
    rows = clustered(700, 12, 1)
    df = spark.createDataFrame(rows, "vec_id long, label int, q array<long>")
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, leaf_rows=leaf_rows, cell_rows=cell, cell_anchors=cell)
    assert as_rows(found) == negatives_by_hand(rows, lambda i: i % 10 == 0)


def test_tree_ranges_eliminate_and_lose_nothing(spark):
    rows = clustered(900, 12, 2)
    q = np.array([r[2] for r in rows])
    largest = float((q * q).sum(axis=1).max()) + 1
    df = spark.createDataFrame(rows, "vec_id long, label int, q array<long>").repartition(4)
    placed, tree, sizes = hard_negatives.build_tree(df, q, 12, largest, len(rows), 5)
    assert sum(sizes.values()) == len(rows) and tree.leaves > 16
    leaf = {r["vec_id"]: r["leaf"] for r in placed.collect()}
    reached = []
    for i in range(0, 900, 30):
        point = np.append(q[i].astype(float), 0.0)
        product = q @ q[i]
        lo, hi = np.quantile(product, [0.9, 0.97])
        around = float(point @ point) + largest
        met = tree.reached(point, np.sqrt(around - 2 * hi), np.sqrt(around - 2 * lo))
        assert {leaf[rows[j][0]] for j in np.flatnonzero((product >= lo) & (product <= hi))} <= set(met)
        reached.append(len(met) / tree.leaves)
    assert np.mean(reached) < 0.6


def test_hard_negatives_odd_rows(spark):
    schema = "vec_id long, label int, q array<long>, slice long, name string, rank int"
    rows = [(0, 1, [3, 4]), (1, 1, [3, 4]), (1, 1, [3, 4]), (2, 2, [3, 3]), (3, 2, [3]), (4, None, [9, 9]), (5, 1, None),
            (6, 2, [None, 3]), (None, 2, [3, 3]), (7, 2, []), (10, 2, [-3, -4]), (10, 3, [0, 1]), (20, 9, [1, 1])]
    df = spark.createDataFrame([(*r, 1, "n", 2) for r in rows], schema)
    usable = [(0, 1, [3, 4]), (1, 1, [3, 4]), (1, 1, [3, 4]), (2, 2, [3, 3]), (3, 2, [3, 0]), (7, 2, [0, 0]),
              (10, 2, [-3, -4]), (10, 3, [0, 1]), (20, 9, [1, 1])]
    found = as_rows(hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0))
    assert found == negatives_by_hand(usable, lambda i: i % 10 == 0) and found
    assert hard_negatives.hard_negatives(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    assert hard_negatives.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0
    huge = spark.createDataFrame([(1, 1, [1 << 40, 1 << 40])], "vec_id long, label int, q array<long>")
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(huge, F.lit(True))
    large = [(i, i % 2, [(1 << 28) + i, (1 << 27) - i]) for i in range(30)]
    df = spark.createDataFrame(large, "vec_id long, label int, q array<long>")
    assert as_rows(hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)) == negatives_by_hand(large, lambda i: i % 10 == 0)


# -- phrases ----------------------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrases_by_hand(docs, least, top=2000):
    import re
    counts, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, 6):
                counts[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        rows = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            inside = any(f >= a for q, f in c.items() if len(q) > len(p) and f >= least
                         and any(q[i:i + len(p)] == p for i in range(len(q))))
            if inside:
                continue
            score, k = min((1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def test_phrases_against_counting(spark):
    rng = random.Random(11)
    vocabulary = ["Aa", "b", "cé", "d", "e'", "漢", "x-y", "zz", "q", "w"]
    docs = []
    for i in range(150):
        n = rng.randint(0, 60)
        docs.append(("".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"])
                             for _ in range(n)), rng.choice(["en", "de", None])))
    passage = " ".join(rng.choice(vocabulary) for _ in range(300))
    docs += [(passage, "en")] * 12 + [("aa " * 3000, "de"), (None, "en"), ("", None), (" .,; \t\n", "fr"), ("word", "fr")]
    df = spark.createDataFrame([(t, l, 1, 2, 3, "p") for t, l in docs],
                               "text string, lang string, weight long, own int, a long, phrase string").repartition(5)
    for least, bits in ((10, phrases.FILTER_BITS), (25, 64)):
        found = phrases.collocations(df, least=least, bits=bits)
        assert sorted(tuple(r) for r in found.collect()) == phrases_by_hand(docs, least)
    assert len(phrases.collocations(df, least=10, top=3).filter("lang = 'en'").collect()) == 3
    assert phrases.collocations(df.limit(0)).count() == 0


def test_parse_owns_every_word_once(spark):
    """Chunks overlap, repeat and are cut where triggers are missing; owned words add up."""
    rng = random.Random(2)
    words = [f"w{rng.randrange(40)}" for _ in range(6000)]
    texts = [" ".join(words)] * 3 + [" ".join(["same"] * 5000)]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    parsed = phrases.dictionary(df).collect()
    assert sum(r["own"] * r["weight"] for r in parsed) == 3 * 6000 + 5000
    lengths = [len(r["chunk"].split(" ")) for r in parsed]
    assert max(lengths) <= phrases.MAX_CHUNK + phrases.OVERLAP
    repeated = [r for r in parsed if "w" in r["chunk"]]
    assert all(r["weight"] % 3 == 0 for r in repeated) and len(repeated) > 200


def test_score_is_exact(spark):
    a, n, l, r = 3_000_000_000_001, 900_000_000_000_000_007, 4_000_000_000_003, 5_000_000_000_029
    found = spark.sql(f"select {a}L as a, {n}L as n, {l}L as l, {r}L as r").select(F.expr(phrases.SCORE)).first()[0]
    assert found == 1000 * a * n // (l * r)
