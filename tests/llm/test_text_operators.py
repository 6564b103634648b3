"""Operators of ``creascope.llm``: edge cases on small tables, brute force, SQL on the test tables."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

import corpus_pipeline
from compare import differences, duck
from creascope.llm import (
    catalog, decontaminate, exact_dedup, html_extract, language_id, line_dedup, minhash_dedup, mixing,
    pii_surrogates, token_counts, toxicity)
from creascope.llm.common import buffers, shingles

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string"


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, empty, white, repeated, very long texts; columns named like results."""
    base, long = words(80, 1), words(30000, 2)
    edited = " ".join([*base.split()[:-1], "changed"])
    texts = [(1, base), (2, base.upper()), (3, edited), (4, None), (5, ""), (6, " \t\n"), (7, "two words"),
             (8, "two words"), (9, long), (10, words(60, 3)), (None, base), (11, None), (12, "Two  words")]
    return spark.createDataFrame([(i, t, None, None, None, 0.5, "x") for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, name):
    assert differences(spark, duck(FOLDER), FOLDER, catalog.QUERIES[name], catalog.ORACLE[name]) is None


def test_near_duplicates_edge_cases(odd, nothing):
    found = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(odd).collect()}
    assert [found[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1]
    assert [found[i]["kept"] for i in (1, 2, 3)] == [True, False, False]
    assert [(found[i]["n_shingles"], found[i]["component_id"], found[i]["kept"]) for i in (4, 5, 6)] == [
        (0, 4, True), (0, 5, True), (0, 6, True)]
    assert [found[i]["component_id"] for i in (7, 8, 12, 9, 10)] == [7, 7, 7, 9, 10]
    assert found[None]["component_id"] is None and found[None]["kept"]
    assert minhash_dedup.near_duplicates(nothing).count() == 0
    kept = minhash_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 9, 10, 11]


def test_near_duplicates_against_all_pairs(spark):
    """An original, copies with more and more edits, and copies of copies."""
    rng = random.Random(4)
    base = words(150, 9).split()
    texts = [base]
    for _ in range(60):
        copy = list(rng.choice(texts[-20:]))
        for _ in range(rng.randint(1, 6)):
            copy[rng.randrange(len(copy))] = words(1, rng.random())
        texts.append(copy)
    sets = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(docs).collect()}
    assert [found[i] for i in range(len(texts))] == label


def test_shingles_count_like_sets():
    texts = ["a b c d e f", "a  b\tc", "", None, "x x x x x x x", "É b c d e"]
    data, offsets = buffers(pa.array(texts))
    hashed, bounds = shingles(data, offsets)
    assert [len(np.unique(hashed[a:b])) for a, b in zip(bounds, bounds[1:])] == [2, 1, 0, 0, 1, 1]


def test_exact_duplicates_edge_cases(odd, nothing, spark):
    rows = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(odd).collect()}
    assert [rows[i]["keep_id"] for i in (1, 2, 4, 5, 11, 6, 7, 8)] == [2, 2, 11, 11, 11, 6, 8, 8]
    assert [rows[i]["group_size"] for i in (1, 4, 7, 3)] == [3, 3, 2, 1]
    assert rows[5]["text_sha256"] == hashlib.sha256(b"").hexdigest()
    assert not rows[None]["kept"] and rows[2]["kept"]
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    twice = odd.unionByName(odd.filter("doc_id = 9"))
    left = exact_dedup.drop_exact_duplicates(twice).collect()
    assert sorted(r["doc_id"] or 0 for r in left) == [0, 2, 3, 6, 8, 9, 10, 11, 12]


def test_golomb_codes_round_trip():
    rng = np.random.default_rng(3)
    for owner, owners, n in ((0, 1, 1), (2, 7, 500), (6, 7, 40)):
        base, end = (exact_dedup.owner_start(o, owners) for o in (owner, owner + 1))
        values = np.unique(rng.integers(base, end, n))
        code = exact_dedup.encode(values, base)
        assert (exact_dedup.decode(code, base) == values).all()
        assert list(exact_dedup.owner_slices(values, owners)) == [(owner, 0, len(values))]


def test_contaminations_edge_cases(spark, odd, nothing):
    item = words(60, 3)
    items = spark.createDataFrame(
        [(1, item), (2, None), (3, ""), (4, "two words"), (None, item), (5, words(20, 77))], "item_id long, text string")
    docs = odd.unionByName(spark.createDataFrame(
        [(20, f"{words(5000, 5)} {item.upper()} {words(3000, 6)}", None, None, None, None, None)], SCHEMA))
    found = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(docs, items).collect())
    assert found == [(7, 4), (8, 4), (10, 1), (12, 4), (20, 1)]
    # blocks of a few shingles find the same
    assert found == sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(docs, items, max_block=5).collect())
    assert decontaminate.contaminations(nothing, items).count() == 0
    assert decontaminate.contaminations(docs, items.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(docs, items).count() == docs.count() - 5


def test_surrogates(spark, nothing):
    texts = [
        "Mail Leo.Fink@Example.org, LEO.FINK@EXAMPLE.ORG or +1 (437) 555-0689.", None, "", "no data here 2.0",
        "+14375550689, 43.21.141.162, 4111 1111 1111 1111; Mrs. Anna Smith and Иван Петров"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii_surrogates.pseudonymised(docs).collect()}
    assert [out[i]["n_entities"] for i in range(5)] == [3, 0, 0, 0, 5]
    assert [out[i]["text"] for i in (1, 2, 3)] == [None, "", "no data here 2.0"]
    first = [text for text in out[0]["text"].rstrip(".").replace(",", "").split()]
    assert first[1].lower() == first[2].lower() and "leo" not in first[1]
    phone = "".join(c for c in " ".join(first[4:]) if c.isdigit())
    assert out[4]["text"].split(",")[0] == f"+{phone}" and phone != "14375550689"
    card = out[4]["text"].split(", ")[2].split(";")[0].replace(" ", "")
    assert pii_surrogates.luhn_digit(card[:-1]) == card[-1]
    title, given = out[4]["text"].split("; ")[1].split()[:2]
    assert title == "Mrs." and given in pii_surrogates.GIVEN["latin", "f"]
    assert out[4]["text"].split()[-2] in pii_surrogates.GIVEN["cyrillic", "m"]
    assert pii_surrogates.pseudonymised(nothing).count() == 0
    emails = [f"user{i}@a.example" for i in range(300)] + [f"u{i}@b.example" for i in range(300)]
    many = spark.createDataFrame([(i, e) for i, e in enumerate(emails)], "doc_id long, text string")
    changed = [r["text"] for r in pii_surrogates.pseudonymised(many).collect()]
    assert len(set(changed)) == len(emails) and not set(changed) & set(emails)


def test_gate_loses_no_entity():
    for number in ("GB29 NWBK 6016 1331 9268 19", "NL91 ABNA 0417 1643 00", "MT84 MALT 0110 0001 2345 MTLC AST0 01S",
                   "IE29AIBK 93115212345678", "DE89 3704 0044 0532 0130 00"):
        assert pii_surrogates.entities(f"Pay {number}, please") == [(4, 4 + len(number), "iban", number.replace(" ", ""))]
    rng = random.Random(12)
    parts = ["GB29", "NWBK", "6016", "MTLC,", "AB12CDEF", "KLMN4567", "01S", "+49", "(437)", "555-0689", "(437) 555-0689",
             "4111", "1111-", "123-45-6789", "43.21.141.162", "a.b@c.example", "x@y", "ü7", "Word", "IN", "a", "0" * 40]
    for _ in range(20000):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", " ", " ", " ", "\t", "\n", "  ", ".", "\xa0"])
                       for _ in range(rng.randint(1, 12)))
        whole = [(m.start(), m.end()) for m in pii_surrogates.NUMBERED.finditer(text)]
        assert [e[:2] for e in pii_surrogates.entities(text) if e[2] != "name"] == whole, text


def test_mix_meets_targets(spark, nothing):
    cells = spark.createDataFrame(
        [("a", "x", "t", 900.0), ("a", "y", "u", 300.0), ("b", "x", "u", 200.0), ("b", "y", "t", 100.0)],
        "source string, lang string, topic string, tokens double")
    aims = {"source": [("a", 0.5), ("b", 0.5)], "lang": [("x", 0.6), ("y", 0.4)], "topic": [("t", 0.5), ("u", 0.5)]}
    targets = {m: spark.createDataFrame(v, f"{m} string, target double") for m, v in aims.items()}
    rows = mixing.rake(cells, targets, rounds=20).collect()
    for margin, wanted in aims.items():
        for value, share in wanted:
            assert sum(r["weight"] * r["tokens"] for r in rows if r[margin] == value) == pytest.approx(share, abs=1e-6)
    assert mixing.sample_mix(nothing).count() == 0


def test_sampled_mix_meets_targets_under_the_bound(spark):
    """One value is so scarce that its cells are taken whole: keep gives way, not the margins."""
    sizes = {("a", "x", "t"): 900, ("a", "x", "u"): 60, ("a", "y", "t"): 200, ("a", "y", "u"): 40, ("b", "x", "t"): 300,
             ("b", "x", "u"): 30, ("b", "y", "t"): 20, ("b", "y", "u"): 50}
    cells = spark.createDataFrame([(*c, float(n)) for c, n in sizes.items()], "source string, lang string, topic string, tokens double")
    targets = {m: mixing.tempered_targets(cells, m) for m in mixing.MARGINS}
    keep = mixing.feasible_keep(cells, targets, 0.5)
    assert 0 < keep < 0.5
    rows = mixing.rake_bounded(mixing.rake(cells, targets), targets, keep, rounds=12)
    assert sum(r["tokens"] * r["probability"] for r in rows.collect()) == pytest.approx(keep * 1600, rel=1e-3)
    assert all(0 <= r["probability"] <= 1 for r in rows.collect())
    for row in mixing.expected_margins(rows, targets).collect():
        assert row["share"] == pytest.approx(row["target"], abs=1e-3)
    docs = spark.createDataFrame([
        (i, " ".join(["w"] * 10 + (["@"] if c[2] == "u" else [])), c[1], c[0]) for i, c in enumerate(
            c for c, n in sizes.items() for _ in range(n))], "doc_id long, text string, lang string, source string")
    found = {r["p"]: r["n"] for r in mixing.sample_mix(docs, meet_targets=True).selectExpr(
        "mix_probability p").groupBy("p").agg({"p": "count"}).toDF("p", "n").collect()}
    assert 0 < sum(found.values()) < 800 and max(found) <= 1


def test_mix_takes_odd_rows(odd):
    sampled = mixing.sample_mix(odd)
    assert sampled.columns == [*odd.columns, "mix_tokens", "mix_probability"]
    assert all(r["doc_id"] is not None for r in sampled.collect())


def test_main_text(spark):
    body = "word " * 40
    page = (f'<nav><a href="/">Home</a></nav><article><h1>A &amp; B</h1><p>{body}<p>Ti.<div class="ad">Buy</div>'
            '<script>var x="</p>";</script><form><label>Mail</label></form></article><footer>end</footer>')
    assert html_extract.main_text(page) == f"A & B\n{body.strip()}\nTi."
    plain = f'<div id="header">Site</div><div><a>One</a> <a>Two</a></div><h1>Title of it all</h1><div>{body}</div><div class="comments">{body}</div>'
    assert html_extract.main_text(plain) == f"Title of it all\n{body.strip()}"
    assert [html_extract.main_text(x) for x in (None, "", "<p>", "a < b", "<p>tiny")] == ["", "", "", "a < b", "tiny"]
    rows = spark.createDataFrame([(1, "u", page), (None, None, None)], "page_id long, url string, html string")
    assert {r["page_id"]: r["n_chars"] for r in html_extract.main_texts(rows).collect()}[None] == 0


def test_main_text_of_unmarked_pages():
    """Adverts inside the text do not end it, a title and a short lead belong to it, far boilerplate does not."""
    one, two = words(60, 31), words(60, 32)
    advert = '<div class="ad"><p>Buy</p><p>it</p><p>now</p><p>cheap</p></div>'
    menu = "<nav>" + "".join(f'<li><a href="/{i}">Part {i}</a></li>' for i in range(12)) + "</nav>"
    page = (f"{menu}<h1>Title</h1><p>Lead</p><p>By me</p><p>{one}</p>{advert}<p>{two}</p><ul><li>a<li>b<li>c<li>d</ul>{menu}"
            "<p>All rights</p>")
    wanted = f"Title\nLead\nBy me\n{one}\n{two}\na\nb\nc\nd"
    assert html_extract.main_text(page) == wanted
    bare = "<nav>x</nav><footer>y</footer>"
    assert html_extract.main_text(bare) == ""


def test_fuzzy_lines(spark, odd, nothing):
    line = words(60, 21)
    docs = spark.createDataFrame(
        [(1, f"{line}\nshort"), (2, f"other {words(30, 5)}\n\n{line}x\nshort"), (3, None), (4, line.upper())],
        "doc_id long, text string")
    kept = {(r["doc_id"], r["line_no"]): r["kept"] for r in line_dedup.fuzzy_lines(docs).collect()}
    assert kept == {(1, 0): True, (1, 1): True, (2, 0): True, (2, 1): True, (2, 2): kept[2, 2], (2, 3): False,
                    (3, 0): True, (4, 0): False}
    cut = {r["doc_id"]: r["text"] for r in line_dedup.drop_fuzzy_lines(docs).collect()}
    assert cut[1] == f"{line}\nshort" and cut[3] is None and cut[4] == ""
    assert line_dedup.fuzzy_lines(nothing).count() == 0 and line_dedup.fuzzy_lines(odd).count() > 0


def test_fuzzy_lines_link_small_edits(spark):
    """One changed word or typo in lines of 4 to 200 words; two of five words changed is too much."""
    docs, wanted = [], {}
    for i, n in enumerate((4, 10, 11, 12, 20, 40, 80, 200)):
        line = words(n, 100 + i).split()
        typo = [*line[:1], line[1][:2] + "z" + line[1][3:], *line[2:]]
        docs.append((2 * i, " ".join(line)))
        docs.append((2 * i + 1, " ".join(typo if n < 20 else [*line[:n // 2], "zzzzz", *line[n // 2 + 1:]])))
        wanted[2 * i], wanted[2 * i + 1] = True, False
    far = words(5, 90).split()
    docs += [(90, " ".join(far)), (91, " ".join([*far[:3], "zzzzz", "yyyyy"]))]
    found = line_dedup.fuzzy_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["kept"] for r in found} == {**wanted, 90: True, 91: True}


def test_fuzzy_lines_move_only_keys_that_meet(spark, monkeypatch):
    """Of lines without company no band key becomes a row, of a family in one bucket its members do."""
    seen = {}

    def record(members, verify, close, pairs=None):
        seen.update(members=members.count(), pairs=0 if pairs is None else pairs.distinct().count())
        return components(members, verify, close, pairs=pairs)

    components = line_dedup.components_of_buckets
    monkeypatch.setattr(line_dedup, "components_of_buckets", record)
    lone = [(i, words(40, 1000 + i)) for i in range(200)]
    found = line_dedup.fuzzy_lines(spark.createDataFrame(lone, "doc_id long, text string")).collect()
    assert all(r["kept"] for r in found) and seen["members"] < 40 and seen["pairs"] < 40
    base = words(40, 999).split()
    family = [(1000 + i, " ".join([*base[:i], f"w{i:04}", *base[i + 1:]])) for i in range(30)]
    found = line_dedup.fuzzy_lines(spark.createDataFrame(lone + family, "doc_id long, text string")).collect()
    assert seen["members"] >= 30
    assert sorted(r["doc_id"] for r in found if not r["kept"]) == list(range(1001, 1030))


def test_meetings_against_all_pairs():
    """Buckets end where the key or the length does; small ones come as pairs, large ones as members."""
    rng = np.random.default_rng(5)
    blocks = []
    for block in (0, line_dedup.BLOCK_ROWS):
        keys = rng.integers(0, 12, (60, 4)).astype(np.uint64) << np.uint64(40) | rng.integers(0, 40, (60, 4)).astype(np.uint64)
        blocks.append((block, keys, rng.integers(1, 40, 60).astype(np.uint32)))
    owners = 3
    parts = pa.Table.from_batches([line_dedup.sent(*block, owners) for block in blocks])
    pairs, members = set(), {}
    for owner in range(owners):
        mine = parts.filter(pa.compute.equal(parts["owner"], owner))
        for r in (line_dedup.meetings(mine).to_pylist() if len(mine) else []):
            if r["key"] is None:
                pairs.add((r["a"], r["b"]))
            else:
                members.setdefault(r["key"], []).append(r["a"])
    met = pairs | {(a, b) for x in members.values() for a in x for b in x if a < b}
    rows = [(int(k), int(c[i]), block + i) for block, keys, c in blocks for i in range(60) for k in keys[i]]

    def owner_and_print(k):
        return (k >> 32) * owners >> 32, k & 0x7FFFFF

    wanted = {(min(a, b), max(a, b)) for k, c, a in rows for q, d, b in rows
              if a != b and owner_and_print(k) == owner_and_print(q) and abs(c - d) <= line_dedup.CLASSES + 1}
    assert wanted and wanted <= met
    assert all(len(x) > line_dedup.FEW for x in members.values())


def test_fuzzy_lines_common_grams_at_other_places(spark, monkeypatch):
    """Lines of the same phrases in other orders share bands, but neither pairs nor members come of it."""
    seen = {}

    def record(members, verify, close, pairs=None):
        seen.update(members=members.count(), pairs=0 if pairs is None else pairs.distinct().count())
        return components(members, verify, close, pairs=pairs)

    components = line_dedup.components_of_buckets
    monkeypatch.setattr(line_dedup, "components_of_buckets", record)
    rng = random.Random(11)
    phrases = [words(6, 500 + i) for i in range(24)]
    lines = [" ".join(rng.sample(phrases, 12)) for _ in range(200)]
    # one phrase less moves all others, two changed words none
    lines += [" ".join(x.split()[6:]) for x in lines[:20]]
    lines += [" ".join([*x.split()[:30], "zzzzz", "yyyyy", *x.split()[32:]]) for x in lines[20:40]]
    found = line_dedup.fuzzy_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in found if not r["kept"]) == list(range(200, 240))
    assert 40 <= seen["pairs"] + seen["members"] < 1000


def test_places_of_grams_hold_linked_lines():
    """The bands that two linked lines share fit, wherever the edits are and whatever they move; unless by chance a
    gram is gone from one place and new at another one, which never leaves a pair without a band."""
    rng, shared, fit = random.Random(12), 0, 0
    for _ in range(600):
        n, alphabet = rng.choice([12, 30, 60, 90, 300, 900]), rng.choice(["ab ", "abcdefgh ", "abcdef\u00e9\u65e5\U0001f600 "])
        x = [rng.choice(alphabet) for _ in range(n)]
        y, left = list(x), n // 11
        while left > 0:
            i, size = rng.choice([0, len(y), rng.randrange(len(y))]), rng.randint(1, left)
            y[i:i + rng.choice([0, size])] = [rng.choice(alphabet) for _ in range(rng.choice([0, size]))]
            left -= size
        # no white space at the ends or doubled, as in normalised lines
        pair = [" ".join("".join(z).split()) for z in (x, y)]
        pair = sorted((z for z in pair), key=len)
        sizes = np.array([len(z) for z in pair])
        if not line_dedup.distance(*(np.array([ord(c) for c in z]) for z in pair), 1000) * 10 <= sizes[1]:
            continue
        classes = line_dedup.length_class(sizes, 90).astype(np.uint64) << np.uint64(line_dedup.PLACE_BITS)
        keys, _, cells = line_dedup.signatures(
            [z.encode() for z in pair], sizes, line_dedup.GRAM if n > line_dedup.SHORT else line_dedup.SHORT_GRAM)
        same = np.flatnonzero(keys[0] == keys[1])
        found = line_dedup.fitting(classes[0] | cells[0, same], classes[1] | cells[1, same], 90)
        assert found.any() or not len(same)
        shared, fit = shared + len(same), fit + int(found.sum())
    assert shared > 4000 and fit >= 0.995 * shared, (shared, fit)
    _, _, cells = line_dedup.signatures([b"\xff" + b"not UTF-8, so no place is known"], np.array([31]), 4)
    assert (cells == (1 << line_dedup.PLACE_BITS) - 1).all()


def test_meetings_of_a_family_are_members():
    """A large family in a bucket is given up to rows per member; the lines around it that fit nobody are left out."""
    rng = np.random.default_rng(6)
    for family in (40, 1000):
        n = family + 300
        keys, classes = np.full((n, 1), 7, np.uint64), np.full(n, 200, np.uint32)
        cells = rng.integers(0, line_dedup.ANYWHERE, (n, line_dedup.ROWS)).astype(np.uint32)
        cells[:family] = [10, 60, 110]
        cells = sum(cells[:, i] << np.uint32(line_dedup.CELL_BITS * i) for i in range(line_dedup.ROWS))
        order = rng.permutation(n)
        met = line_dedup.meetings(pa.Table.from_batches([line_dedup.sent(0, keys, classes, 1, cells[order][:, None])]))
        held = {r["a"] for r in met.to_pylist() if r["key"] is not None}
        assert held >= set(np.flatnonzero(order < family).tolist()) and len(met) <= n + 300
        assert family > 40 or len(held) < family + 20


def test_linked_pairs_against_edit_distance():
    def distance(x, y):
        above = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            row = [i]
            for j, d in enumerate(y, 1):
                row.append(min(above[j - 1] + (c != d), above[j] + 1, row[-1] + 1))
            above = row
        return above[-1]

    rng = random.Random(4)
    lefts, rights = ["", "a", "abc" * 30], ["", "", "bca" * 30]
    for _ in range(300):
        x = [rng.choice("abcde\u00e9 \u65e5\U0001f600") for _ in range(rng.choice([1, 3, 10, 30, 60, 100]))]
        y = list(x)
        for _ in range(rng.randint(0, max(1, len(x) // 6))):
            i, kind = rng.randrange(len(y) + 1), rng.random()
            y[i:i + (kind < 0.7)] = [] if kind < 0.3 else [rng.choice("abcde")]
        lefts.append("".join(x))
        rights.append("".join(y))
    ids = pa.array(range(len(lefts)))
    rows = pa.RecordBatch.from_arrays([ids, ids, pa.array(lefts), pa.array(rights)], names=["a", "b", "x", "y"])
    for percent in (90, 70):
        found = next(line_dedup.linked_pairs(iter([rows]), percent)).column(0).to_pylist()
        assert found == [i for i, (x, y) in enumerate(zip(lefts, rights))
                         if distance(x, y) <= max(len(x), len(y)) * (100 - percent) // 100]
    points = [tuple(np.array([ord(c) for c in z], np.uint32) for z in pair) for pair in zip(lefts, rights) if pair[0]]
    for x, y in points[::5]:
        wanted = distance(x, y)
        assert line_dedup.distance(x, y, 1000) == wanted and line_dedup.distance(x, y, 2) == min(wanted, 3)
    # the profile of a line never asks for more edits than the distance
    lines = [x.encode() or b"x" for x in lefts + rights]
    sizes = np.array([len(x.decode()) for x in lines])
    words_of = line_dedup.profiles(lines, sizes)
    for i in range(0, len(lefts), 3):
        j = i + len(lefts)
        moved = np.bitwise_count(words_of[i] ^ words_of[j]).sum() + abs(sizes[i] - sizes[j])
        assert moved <= 2 * distance(lines[i].decode(), lines[j].decode())


def test_toxicity_learns_subwords(spark, odd, nothing):
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        body = [words(1, rng.random()) for _ in range(30)]
        if toxic:
            body[rng.randrange(30)] = "blorkhead" + rng.choice(["", "s", "ed"])
        texts.append(" ".join(body))
        labels.append(int(toxic))
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(600)), pa.array(labels, pa.int32()), pa.array(texts)], names=["id", "label", "text"])
    model = toxicity.train(pa.Table.from_batches(toxicity.bags(iter([rows]))), np.array(labels))
    seen = [" ".join([words(20, 99), w, words(9, 98)]) for w in ("blorkhead", "blorkheeads", "harmless")]
    docs = spark.createDataFrame(list(enumerate(seen)), "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, model).collect()}
    assert score[0] > 0.3 and score[1] > score[2] and score[2] < 0.3
    rows = toxicity.toxicity(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert toxicity.drop_toxic(nothing, model).count() == 0


def test_languages_held_out(spark, odd, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit_model(docs)
    found = language_id.languages(docs, model).filter("held_out").join(docs, "doc_id")
    assert found.filter("lang_pred = lang").count() >= 0.98 * found.count()
    rows = {r["doc_id"]: r["lang_pred"] for r in language_id.languages(odd, model).collect()}
    assert rows[4] == rows[5] == rows[6] == "und"
    assert language_id.fit_model(nothing)["languages"] == ["und"]


def test_token_counts_against_greedy_search(spark, odd):
    entries = [b"a", b"ab", b"abcd", b"bc", b" a", b" abc", b"cde", b"dd"]
    machine, known = token_counts.Automaton(entries), {*entries, *(bytes([b]) for b in range(256))}
    rng = random.Random(6)
    for _ in range(500):
        word = bytes(rng.choice(b" abcde") for _ in range(rng.randint(0, 12)))
        at = count = 0
        while at < len(word):
            at = next(j for j in range(len(word), at, -1) if word[at:j] in known)
            count += 1
        assert machine.count(word) == count
    rows = {r["doc_id"]: r for r in token_counts.token_counts(odd).collect()}
    assert [rows[i]["n_tokens"] for i in (4, 5, 6)] == [0, 0, 0] and rows[7]["n_words"] == 2


def test_pipeline_keeps_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns[:5] == docs.columns and 0 < out.count() < docs.count()
