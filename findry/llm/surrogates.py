"""Personal data replaced by surrogates that keep type, script, gender and format.

Found are e-mail addresses, telephone, card and social security numbers, IPv4 addresses, secrets
(named tokens, long hexadecimal strings) and names of persons after a title.  Every entity has a
canonical form (lower case, or digits only), and a keyed hash of kind and canonical form draws its
surrogate: letters stay letters of the same script, digits digits, a country code, the kind of a card
and its check digit, a top-level domain and the gender a title tells are kept, and so are case and
punctuation of each mention.  One entity thus gets one surrogate in all documents and spellings.

Distinctness is checked over the whole table: all different entities are gathered, and a surrogate
that two of them draw, that is itself an entity, or that was given out before is drawn again
for all but one.  Where a format has no free form left, surrogates grow longer than it.  The few entities that were drawn again travel to the scan as a broadcast if they are few
enough (``EXCEPTIONS``), else by a join.

Null and empty texts stay as they are; rows need no unique doc_id.  Other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.llm.scratch import Scratch

DIGITS = "0123456789"
KEY = b"findry surrogates: replace this key in production"
# Re-drawn entities that are broadcast at most; more are joined.
EXCEPTIONS = 100_000
DRAWS = 200
# Draws that keep the format; later ones make the surrogate longer, by one character more every second draw, as all
# forms of a short format may be taken (there are 676 addresses like a@b.de).
FORMAT_DRAWS = 4

_NUMBERLIKE = re.compile(r"[+(\d][\d ().+-]{5,}")
_CARD = re.compile(r"(?<![\d.-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|3[47]\d\d([ -])\d{6}\2\d{5}|\d{13,19})"
                   r"(?!\d|[.-]\d)")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]|\.\d)")
_IP = re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)")
_PHONE = re.compile(
    r"\+\d{1,3}[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|\+\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d)"
    r"|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]|\.\d)")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w])")
_SECRET = re.compile(
    r"(?i:token|secret|password|api[_-]?key)[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9_/+-]{12,})")
_HEX = re.compile(r"(?<![0-9A-Za-z])(?=[a-f]*\d)[0-9a-f]{32,}(?![0-9A-Za-z])"
                  r"|(?<![0-9A-Za-z])(?=[A-F]*\d)[0-9A-F]{32,}(?![0-9A-Za-z])")
_SECRET_HINTS = ("oken", "OKEN", "ecret", "ECRET", "assword", "ASSWORD", "key", "KEY")
# Titles and the gender they tell (fixed values).
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Herr": "m", "Frau": "f", "Monsieur": "m",
          "Madame": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f", "Señorita": "f", "Signor": "m",
          "Signora": "f", "Dr": "n", "Prof": "n", "Doctor": "n", "Professor": "n",
          "господин": "m", "госпожа": "f", "κύριος": "m", "κυρία": "f"}
_NAME = re.compile(
    r"(?<!\w)(" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")\.? (?=((?:[^\W\d_]+[ -]?){1,4}))")
# Alphabets by script, and syllables and endings for names (fixed values).
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
             "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
SYLLABLES = {
    "latin": ["ba", "be", "bo", "da", "de", "do", "fe", "ga", "go", "ka", "ko", "la", "le", "li", "lo",
              "ma", "me", "mi", "mo", "na", "ne", "ni", "no", "ra", "re", "ri", "ro", "sa", "se",
              "si", "so", "ta", "te", "ti", "to", "va", "ve", "vi", "vo", "za"],
    "cyrillic": ["ба", "ва", "га", "да", "ди", "ка", "ко", "ла", "ле", "ли", "ма", "ми", "мо", "на",
                 "ни", "но", "ра", "ри", "ро", "са", "се", "та", "ти", "то"],
    "greek": ["βα", "γα", "δα", "δη", "κα", "κο", "λα", "λε", "λι", "μα", "μι", "μο", "να", "νι",
              "νο", "ρα", "ρι", "ρο", "σα", "σε", "τα", "τι", "το"]}
ENDINGS = {("latin", "n"): "", ("cyrillic", "n"): "", ("greek", "n"): "",
           ("latin", "m"): "n", ("latin", "f"): "a", ("cyrillic", "m"): "н", ("cyrillic", "f"): "на",
           ("greek", "m"): "ς", ("greek", "f"): "νη"}


def script(text: str) -> str:
    """The alphabet that most of the letters belong to; Latin where it is none of ours."""
    first = next((c for c in text if c.isalpha()), "a")
    if "Ѐ" <= first <= "ԯ":
        return "cyrillic"
    if "Ͱ" <= first <= "Ͽ" or "ἀ" <= first <= "῿":
        return "greek"
    return "latin"


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def find(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, canonical)`` of all entities, in order and without overlap."""
    found = []
    at, past = text.find("@"), 0
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        # Back to what can't belong to a local part, or to the '@' before; so each is read once.
        start = at
        while domain and start > past and (text[start - 1].isalnum() or text[start - 1] in "_.+%-"):
            start -= 1
        past = at + 1
        if domain:
            while start < at and text[start] in ".+%-":
                start += 1
            if start < at:
                found.append((start, domain.end(), "email", text[start:domain.end()].lower()))
        at = text.find("@", at + 1)
    digits = False
    for near in _NUMBERLIKE.finditer(text):
        digits = True
        a, b = near.span()
        for kind, pattern in (("card", _CARD), ("ssn", _SSN), ("ip", _IP), ("phone", _PHONE)):
            for m in pattern.finditer(text, a, b):
                if any(m.start() < e and s < m.end() for s, e, _, _ in found[-8:]):
                    continue
                if kind == "ip":
                    if all(int(x) <= 255 for x in m[0].split(".")):
                        found.append((*m.span(), kind, ".".join(str(int(x)) for x in m[0].split("."))))
                    continue
                plain = "".join(filter(str.isdigit, m[0]))
                if kind == "phone" and m[0][0] == "+":
                    code = re.match(r"\+(\d{1,3})(?=[ .(-])", m[0])
                    plain = f"+{code[1]}/{plain[len(code[1]):]}" if code else "+/" + plain
                found.append((*m.span(), kind, plain))
    if any(h in text for h in _SECRET_HINTS):
        found += [(*m.span(1), "secret", m[1]) for m in _SECRET.finditer(text)]
    if digits or re.search(r"\d[0-9a-fA-F]{3}", text):
        found += [(*m.span(), "secret", m[0]) for m in _HEX.finditer(text)]
    if any(t in text for t in TITLES):
        found += _names(text)
    found.sort(key=lambda x: (x[0], -x[1]))  # of one place what was found first
    out, end = [], 0
    for entity in found:
        if entity[0] >= end:
            out.append(entity)
            end = entity[1]
    return out


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """Names after a title, word by word, and the same names and their words without a title.

    A given name after a title without gender takes the gender another title tells in the text.  A word of
    fewer than three letters is not looked for alone.
    """
    titled, gender_of, kinds = [], {}, {}
    for m in _NAME.finditer(text):
        words = []
        for w in re.finditer(r"[^\W\d_]+", m[2]):
            if not w[0][0].isupper() or len(words) == 4 or len(w[0]) < 2 or w[0] in TITLES:
                break
            words.append((m.start(2) + w.start(), m.start(2) + w.end(), w[0]))
        titled.append((TITLES[m[1]], words))
        for _, _, word in words[:-1]:
            if TITLES[m[1]] != "n":
                gender_of.setdefault(word.lower(), TITLES[m[1]])
    found = []
    for gender, words in titled:
        for i, (a, b, word) in enumerate(words):
            low = word.lower()
            kind = "family" if i == len(words) - 1 else f"given-{gender_of.get(low, gender)}"
            # A word that was a given name elsewhere is that person's name alone as well ("Mr. Karl").
            if kind == "family" and len(words) == 1 and kinds.get(word, kind) != "family":
                kind = kinds[word]
            kinds.setdefault(word, kind)
            found.append((a, b, kind, low))
    alone = sorted((w for w in kinds if len(w) > 2), key=len, reverse=True)
    if alone:
        for m in re.finditer(r"(?<!\w)(?:" + "|".join(map(re.escape, alone)) + r")(?!\w)", text):
            found.append((*m.span(), kinds[m[0]], m[0].lower()))
    return found


class _Draws:
    """Numbers drawn from a keyed hash."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed = key[:64], "\x1f".join(parts).encode("utf-8", "surrogatepass")
        self.block, self.data = 0, b""

    def below(self, n: int) -> int:
        if len(self.data) < 4:
            self.data = hashlib.blake2b(self.seed + self.block.to_bytes(4, "little"),
                                        key=self.key).digest()
            self.block += 1
        value, self.data = int.from_bytes(self.data[:4], "little"), self.data[4:]
        return value * n >> 32


def surrogate(kind: str, canonical: str, draw: int = 0, key: bytes = KEY) -> str:
    """Canonical form of the surrogate of an entity; ``draw`` counts how often it was drawn before."""
    rnd = _Draws(key, kind, canonical, str(draw))
    longer = max(0, (draw - FORMAT_DRAWS + 2) // 2)

    def more(letters: str) -> str:
        return "".join(letters[rnd.below(len(letters))] for _ in range(longer))

    def other(c: str) -> str:
        if c.isdigit():
            return str(rnd.below(10))
        if c.isalpha():
            letters = ALPHABETS[script(c)]
            out = letters[rnd.below(len(letters))]
            return out.upper() if c.isupper() else out
        return c

    if kind == "email":
        name, _, domain = canonical.rpartition("@")
        host, _, top = domain.rpartition(".")
        return "".join(map(other, name)) + more(ALPHABETS[script(name)]) + "@" + "".join(map(other, host)) + "." + top
    if kind == "ip":
        return ".".join(str(1 + rnd.below(254)) for _ in range(4)) + ("-" + more(DIGITS) if longer else "")
    if kind == "card":
        body = canonical[0] + "".join(str(rnd.below(10)) for _ in canonical[1:-1])
        good = str(-_luhn(body + "0") % 10)
        if _luhn(canonical):  # a number that fails the check keeps failing it
            good = str((int(good) + 1 + rnd.below(9)) % 10)
        return body + good + more(DIGITS)
    if kind == "ssn":
        area = 1 + rnd.below(665)
        return f"{area:03d}{1 + rnd.below(99):02d}{1 + rnd.below(9999):04d}" + more(DIGITS)
    if kind == "phone":
        code, slash, rest = canonical.rpartition("/")
        new = [str(rnd.below(10)) for _ in rest]
        if len(rest) == 10:  # area and exchange begin with 2 to 9
            new[0], new[3] = str(2 + rnd.below(8)), str(2 + rnd.below(8))
        return code + slash + "".join(new) + more(DIGITS)
    if kind == "secret":
        if re.fullmatch(r"[0-9a-fA-F]+", canonical):
            digits = "0123456789ABCDEF" if any("A" <= c <= "F" for c in canonical) \
                else "0123456789abcdef"
            return "".join(digits[rnd.below(16)] for _ in canonical) + more(digits)
        return "".join(map(other, canonical)) + more(ALPHABETS["latin"])
    own = script(canonical)
    parts = SYLLABLES[own]
    stem = "".join(parts[rnd.below(len(parts))] for _ in range(2 + (draw + 1) // 2))
    return stem + (ENDINGS[own, kind[-1]] if kind.startswith("given") else "")


def render(mention: str, kind: str, new: str) -> str:
    """The canonical surrogate in the format of the mention it replaces."""
    if kind in ("ip", "secret"):
        return new
    if kind.startswith(("given", "family")):
        return new.upper() if mention.isupper() and len(mention) > 1 else new.capitalize()
    if kind == "email":
        return "".join(c.upper() if m.isupper() else c for m, c in zip(mention, new)) \
            if len(mention) == len(new) else new
    digits = iter(filter(str.isdigit, new))
    return "".join(next(digits, "0") if c.isdigit() else c for c in mention) + "".join(digits)


def replace(text: str, again: dict | None = None, key: bytes = KEY):
    """The text with surrogates, and ``(kind, start, end, surrogate)`` of each in the old text."""
    found = find(text)
    if not found:
        return text, []
    out, spans, at = [], [], 0
    for start, end, kind, canonical in found:
        draw = again.get((kind, canonical), 0) if again else 0
        new = render(text[start:end], kind, surrogate(kind, canonical, draw, key))
        out += [text[at:start], new]
        spans.append((kind, start, end, new))
        at = end
    out.append(text[at:])
    return "".join(out), spans


def _mentions(docs: DataFrame) -> DataFrame:
    """``(row, kind, value)``: the different entities of every row; ``row`` is a hash of it."""

    def run(batches):
        for batch in batches:
            rows, kinds, values = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for kind, value in sorted({f[2:] for f in find(text)}) if text else ():
                    rows.append(row)
                    kinds.append(kind)
                    values.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(kinds, pa.string()),
                 pa.array(values, pa.string())], ["row", "kind", "value"])

    return docs.select(F.xxhash64("text").alias("row"), "text").mapInArrow(
        run, "row long, kind string, value string")


def redraws(entities: DataFrame, scratch: Scratch, key: bytes = KEY) -> DataFrame | None:
    """``(kind, value, draw)`` of the entities whose first surrogate was taken; None if there are none."""

    def draw(number):
        def run(batches):
            for batch in batches:
                new = [surrogate(k, v, number, key) for k, v in
                       zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(new, pa.string())],
                    ["kind", "value", "new"])
        return run

    pending, taken, later = entities, None, None
    for number in range(DRAWS):
        drawn = scratch.keep(
            pending.mapInArrow(draw(number), "kind string, value string, new string"),
            f"drawn{number}")
        free = drawn.groupBy("kind", "new").agg(F.min("value").alias("value"))
        names = entities.select("kind", F.col("value").alias("new"))
        free = free.join(names, ["kind", "new"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["kind", "new"], "left_anti")
        settled = scratch.keep(free, f"settled{number}")
        taken = settled.select("kind", "new") if taken is None else taken.unionByName(
            settled.select("kind", "new"))
        if number:
            mine = settled.select("kind", "value", F.lit(number).alias("draw"))
            later = mine if later is None else later.unionByName(mine)
        pending = drawn.join(settled, ["kind", "value", "new"], "left_anti").select("kind", "value")
        if pending.isEmpty():
            return later
    raise RuntimeError(f"no free surrogates after {DRAWS} draws")


def pseudonymise(docs: DataFrame, key: bytes = KEY, exceptions: int = EXCEPTIONS) -> DataFrame:
    """``docs`` with surrogates in ``text``, plus ``entities`` (kind, place in the old text, surrogate).

    A column named ``entities`` in the input is replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "surrogates")
    docs = docs.drop("entities")
    entities = scratch.keep(_mentions(docs).select("kind", "value").distinct(), "entities")
    again = redraws(entities, scratch, key)
    known, source = {}, docs
    per_row = False
    if again is not None:
        again = scratch.keep(again, "again")
        if again.count() <= exceptions:
            known = {(r["kind"], r["value"]): r["draw"] for r in again.toLocalIterator()}
        else:
            per_row = True
            own = scratch.keep(
                _mentions(docs).join(again, ["kind", "value"]).distinct()
                .groupBy(F.col("row").alias("__row"))
                .agg(F.collect_list(F.struct("kind", "value", "draw")).alias("__redrawn")), "own")
            source = (docs.withColumn("__row", F.xxhash64("text")).join(own, "__row", "left")
                      .select(*docs.columns, "__redrawn"))
    held = spark.sparkContext.broadcast(known)
    spot = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType()),
                         T.StructField("surrogate", T.StringType())])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("surrogate", pa.string())]))
    place, width = docs.columns.index("text"), len(docs.columns)

    def run(batches):
        for batch in batches:
            texts, spots = [], []
            redrawn = batch.column(width).to_pylist() if per_row else None
            for i, text in enumerate(batch.column(place).to_pylist()):
                spans = []
                if text:
                    mine = held.value
                    if per_row:
                        mine = {(r["kind"], r["value"]): r["draw"] for r in redrawn[i] or ()}
                    text, spans = replace(text, mine, key)
                texts.append(text)
                spots.append([dict(zip(("kind", "start", "end", "surrogate"), s)) for s in spans])
            columns = batch.columns[:width]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(spots, kind)], [*docs_columns, "entities"])

    docs_columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("entities", T.ArrayType(spot))])
    return source.mapInArrow(run, schema)
