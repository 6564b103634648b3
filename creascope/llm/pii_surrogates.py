"""Personal data replaced by keyed surrogates of the same type, format, gender and script.

1. One scan finds the entities of every text. An entity is known by its type and canonical form (an
   email in lower case, a phone number's digits), so different spellings share a surrogate.
2. Every distinct entity gets a surrogate from an HMAC of a key, its type and canonical form: digits
   for digits, letters for letters, valid octets and check digits, first names of the same gender
   and script. Surrogates that meet each other, or an entity that really occurs, are drawn again
   with the next attempt number until all are distinct.
3. The surrogates of a text's entities are joined to it by the digest of the text, and written in the
   entity's own layout (case, blanks, punctuation). Texts without entities are not shuffled.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from creascope.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# First names by script and gender; titles say the gender of the name that follows.
GIVEN = {
    ("latin", "f"): "Anna Maria Julia Laura Sara Emma Clara Helena Sofia Elena Marta Nora Irene Lucia Alice Eva Diana Carla".split(),
    ("latin", "m"): "Peter Thomas David Martin Daniel Robert Victor Simon Oscar Felix Hugo Marco Adrian Leon Paul Max Karl Bruno".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана Юлия Вера Нина Дарья".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Андрей Алексей Дмитрий Николай Михаил Павел Виктор Борис Олег".split(),
}
TITLES = {"Mr": "m", "Herr": "m", "Señor": "m", "Monsieur": "m", "Sir": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Señora": "f", "Madame": "f"}
# Letters that stand in for a letter, by script; positions beyond are taken modulo the length.
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу"}
CONSONANTS = {"latin": "bcdfghklmnprstvz", "cyrillic": "бвгдзклмнпрст"}

_given = {name: kind for kind, names in GIVEN.items() for name in names}
PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"),
    ("secret", r"(?<![0-9A-Za-z])[0-9a-f]{40}(?![0-9A-Za-z])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"),
    ("card", r"(?<![\d+])\d{4}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{4}(?!\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
              r"|(?<![\w+])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w+-])\d{3}-\d{3}-\d{4}(?![\d-])"),
    ("name", r"(?<!\w)(?:(?:%s)\.? (?:[A-ZÀ-ÖØ-ÞА-Я][\w'’-]+ ){0,1}[A-ZÀ-ÖØ-ÞА-Я][\w'’-]+|(?:%s) [A-ZÀ-ÖØ-ÞА-Я][\w'’-]{2,})" % (
        "|".join(TITLES), "|".join(_given))),
)
NUMBERED = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in PATTERNS if name != "name"))
NAMED = re.compile(dict(PATTERNS)["name"])
# where an entity can be: a sign that addresses and numbers have, or a capital word
SIGN = re.compile(r"[@\d]")
# the words that can go on with an entity: those with a digit, and an IBAN's groups of capitals
REST = re.compile(r"\S*(?:[ \t]\(?\S*?\d\S*| [A-Z]+(?![0-9A-Za-z])\S*)*")
CAPITAL = re.compile(r"(?<!\w)[A-ZА-Я]\w+")
OPENERS = frozenset([*TITLES, *_given])


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) from left to right, without overlaps.

    Only the words around a digit or an at sign with the words of capitals after them, and capital
    words that can open a name, are matched against the patterns; this loses no match.
    """
    found, at = [], 0
    while sign := SIGN.search(text, at):
        start = max(text.rfind(" ", at, sign.start()) + 1, text.rfind("\n", at, sign.start()) + 1, at)
        at = REST.match(text, sign.start()).end()
        for match in NUMBERED.finditer(text, start, at):
            kind = next(name for name, _ in PATTERNS if name != "name" and match.group(name) is not None)
            found.append((match.start(), match.end(), kind, canonical(kind, match.group())))
    numbered, named = len(found), 0
    for word in CAPITAL.finditer(text):
        if word.start() >= named and word.group() in OPENERS:
            match = NAMED.match(text, word.start())
            if match and not any(s < match.end() and match.start() < e for s, e, _, _ in found[:numbered]):
                found.append((match.start(), match.end(), "name", canonical("name", match.group())))
                named = match.end()
    return sorted(found) if len(found) > numbered else found


def canonical(kind: str, value: str) -> str:
    if kind in ("card", "ssn", "phone"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "name":
        parts = value.split()
        return " ".join(parts[1:] if parts[0].rstrip(".") in TITLES else parts) + "/" + gender(parts)
    return value.lower()


def gender(parts: list[str]) -> str:
    if parts[0].rstrip(".") in TITLES:
        return TITLES[parts[0].rstrip(".")]
    return _given[parts[0]][1] if parts[0] in _given else "?"


def script(word: str) -> str:
    return "cyrillic" if any("А" <= c <= "я" or c in "ёЁ" for c in word) else "latin"


class Stream:
    """Numbers from an HMAC in counter mode."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.count, self.held = key, "\x1f".join(parts).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.held) < 4:
            self.held += hmac.new(self.key, self.seed + self.count.to_bytes(4, "big"), hashlib.sha256).digest()
            self.count += 1
        value, self.held = int.from_bytes(self.held[:4], "big"), self.held[4:]
        return value % n


def same_letters(word: str, draw: Stream) -> str:
    """Digits for digits, letters for letters of the script and case, everything else as it is."""
    out = []
    for i, c in enumerate(word):
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            kind = script(c)
            letters = (VOWELS if i % 2 else CONSONANTS)[kind]
            new = letters[draw.below(len(letters))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def luhn_digit(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (2 - i % 2)
        total += value - 9 * (value > 9)
    return str(-total % 10)


def surrogate(key: bytes, kind: str, form: str, attempt: int) -> str:
    """The surrogate's canonical form."""
    draw = Stream(key, kind, form, str(attempt))
    if kind == "email":
        local, domain = form.rsplit("@", 1)
        *labels, top = domain.split(".")
        # one domain keeps one surrogate, whoever's address it is in
        return f"{same_letters(local, draw)}@{'.'.join(same_letters(x, Stream(key, 'domain', x)) for x in labels)}.{top}"
    if kind == "ip":
        first = form.split(".")[0]
        private = first in ("10", "127")
        return ".".join([first if private else str(1 + draw.below(223))] + [str(draw.below(256)) for _ in range(3)])
    if kind == "secret":
        return "".join("0123456789abcdef"[draw.below(16)] for _ in form)
    if kind == "card":
        body = form[0] + "".join(str(draw.below(10)) for _ in form[1:-1])
        right = luhn_digit(body)
        if luhn_digit(form[:-1]) == form[-1]:
            return body + right
        return body + str((int(right) + 1 + draw.below(9)) % 10)
    if kind == "ssn":
        return "".join(str(draw.below(10)) for _ in form)
    if kind == "phone":
        kept = 1 if form[0] in "17" else 2
        return form[:kept] + "".join(str(draw.below(10)) for _ in form[kept:])
    if kind == "iban":
        return form[:2] + "".join(
            str(draw.below(10)) if c.isdigit() else "ABCDEFGHKLMNPRSTUVWXYZ"[draw.below(22)] for c in form[2:])
    full, sex = form.rsplit("/", 1)
    parts = full.split()
    sex = sex if sex in "mf" else "mf"[draw.below(2)]
    new = [same_letters(parts[-1], draw)]
    if len(parts) > 1:
        names = GIVEN[script(parts[0]), sex]
        new.insert(0, names[draw.below(len(names))])
    return " ".join(new) + "/" + form.rsplit("/", 1)[1]


def laid_out(kind: str, value: str, form: str) -> str:
    """A surrogate's canonical form in the layout of the entity it replaces."""
    if kind in ("card", "ssn", "phone", "iban"):
        marks = iter(form)
        return "".join(next(marks) if c.isalnum() else c for c in value)
    if kind == "name":
        first, _, rest = value.partition(" ")
        new = form.rsplit("/", 1)[0]
        return f"{first} {new}" if first.rstrip(".") in TITLES else new
    if kind == "email":
        return form.upper() if value.isupper() else form
    return form


# -- tasks ------------------------------------------------------------------------------------

def digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def entity_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_key, type, form) for every distinct entity of a text."""
    for batch in batches:
        keys, kinds, forms = [], [], []
        for text in batch.column(0).to_pylist():
            if text:
                found = {(kind, form) for _, _, kind, form in entities(text)}
                keys += [digest(text)] * len(found)
                kinds += [kind for kind, _ in found]
                forms += [form for _, form in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(kinds, pa.string()), pa.array(forms, pa.string())],
            names=["text_key", "kind", "form"])


def surrogate_rows(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
        made = [surrogate(key, kind, form, attempt) for kind, form, attempt in rows]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.string())],
                                         names=["kind", "form", "attempt", "surrogate"])


def keyed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) and the text's digest if it has entities."""
    for batch in batches:
        keys = [digest(t) if t and entities(t) else None for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(keys, pa.binary())], names=["doc_id", "text", "text_key"])


def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_entities, text) with the surrogates in ``found`` written in."""
    for batch in batches:
        texts, counts = [], []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            table = {(x["kind"], x["form"]): x["surrogate"] for x in found}
            out, at, n = [], 0, 0
            for start, end, kind, form in entities(text):
                out += [text[at:start], laid_out(kind, text[start:end], table[kind, form])]
                at, n = end, n + 1
            texts.append("".join([*out, text[at:]]))
            counts.append(n)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(texts, pa.string())],
                                         names=["doc_id", "n_entities", "text"])


def surrogate_table(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, surrogate): distinct within a kind, and no form that really occurs."""
    real = stored(found.select("kind", "form").distinct(), "entities")
    schema = "kind string, form string, attempt int, surrogate string"
    settled, open_ = None, real.withColumn("attempt", F.lit(0))
    while True:
        drawn = stored(open_.mapInArrow(lambda b: surrogate_rows(b, key), schema), "drawn")
        every = drawn.withColumn("old", F.lit(0))
        if settled is not None:
            every = every.unionByName(settled.withColumn("old", F.lit(1)))
        # an earlier draw has priority, then the smallest form
        owner = every.groupBy("kind", "surrogate").agg(
            F.min(F.struct((1 - F.col("old")).alias("new"), "form")).alias("first"))
        taken = real.select("kind", F.col("form").alias("surrogate"), F.lit(True).alias("taken"))
        judged = drawn.join(owner, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left").withColumn(
            "good", (F.col("first.form") == F.col("form")) & F.col("taken").isNull())
        judged = stored(judged.select("kind", "form", "attempt", "surrogate", "good"), "judged")
        good = judged.filter("good").drop("good")
        settled = good if settled is None else settled.unionByName(good)
        left = judged.filter("not good")
        if left.isEmpty():
            return settled.select("kind", "form", "surrogate")
        open_ = left.select("kind", "form", (F.col("attempt") + 1).alias("attempt"))


def pseudonymised(docs: DataFrame, key: str = "surrogates", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_entities, text) for every row of ``docs``, entities replaced.

    One entity has one surrogate in all texts and distinct entities have distinct ones. NULL texts
    stay NULL with 0 entities, texts without entities stay as they are. NULL ids and repeated rows
    are returned as they are. Other columns are not read. ``key`` is the secret of the mapping.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = stored(texts.select("text").mapInArrow(
        entity_rows, "text_key binary, kind string, form string").distinct(), "found")
    table = surrogate_table(found, key.encode())
    of_text = found.join(table, ["kind", "form"]).groupBy("text_key").agg(
        F.collect_list(F.struct("kind", "form", "surrogate")).alias("found"))
    marked = texts.mapInArrow(keyed_texts, "doc_id long, text string, text_key binary")
    changed = marked.filter("text_key is not null").join(of_text, "text_key").select("doc_id", "text", "found").mapInArrow(
        replaced, "doc_id long, n_entities long, text string")
    same = marked.filter("text_key is null").select("doc_id", F.lit(0).cast("long").alias("n_entities"), "text")
    return changed.unionByName(same)
