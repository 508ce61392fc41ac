"""Replacement of personal data by surrogates.

Entities are found by pattern, brought to one canonical form each, and given a surrogate that
a secret key decides: of the same kind, script, gender and format. The distinct entities of the corpus
are checked in Spark: two entities never share a surrogate and no surrogate is itself an entity of the
corpus; those that clash draw again. As every mention of an entity has the same canonical
form, it gets the same surrogate in all documents, written in the format of the mention.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custoria.llm.common import as_bytes, columns_of, rows_of
from custoria.session import materialize

#: Clashes after which an entity's surrogate comes from a wider space, which grows on with each clash.
CLASHES = 3
#: Draws of one entity before the job gives up: only numbers of a fixed length can need so many, when most of them are taken.
DRAWS = 256

# Titles and common given names, by gender.
MALE = frozenset("mr mister sir herr monsieur m señor sr don signor г-н господин κύριος κος".split())
FEMALE = frozenset("mrs ms miss madam frau madame mme mademoiselle mlle señora señorita sra srta doña signora г-жа госпожа κυρία κα".split())
NEUTRAL = frozenset("mx dr prof professor dra".split())
GIVEN_MALE = frozenset("james john robert michael william david richard joseph thomas charles daniel matthew anthony mark paul steven andrew peter hans jürgen klaus wolfgang pierre jean jacques françois josé carlos luis miguel иван сергей алексей дмитрий γιώργος νίκος".split())
GIVEN_FEMALE = frozenset("mary patricia jennifer linda elizabeth barbara susan jessica sarah karen lisa nancy margaret sandra emily anna helga ursula sabine marie françoise nathalie isabelle maría carmen ana lucía мария елена ольга наталья ελένη μαρία".split())

_WORD = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_TITLES = "|".join(sorted((re.escape(t) for t in MALE | FEMALE | NEUTRAL if t != "m"), key=len, reverse=True))
PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[\w.+-]{1,64}@(?:[^\W_](?:[\w-]{0,61}[^\W_])?\.)+[^\W\d_]{2,24}(?![\w-])"),
    "url_password": re.compile(r"(?<=://)[^\s/:@]+:[^\s/@]+(?=@)"),
    "secret": re.compile(r"(?i:(?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?)([A-Za-z0-9_/+.~-]{8,}={0,2})"),
    "aws_key": re.compile(r"(?<![A-Z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Z0-9])"),
    "iban": re.compile(r"(?<![A-Z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "card": re.compile(r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d-])"),
    "ip": re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"),
    "ssn": re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "phone": re.compile(r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}(?![\w-])|(?<![\w+])\+\d{8,15}(?!\w)"),
    "person": re.compile(rf"(?<![\w’'-])(?:(?i:({_TITLES}))\.?\s|(?=({_WORD})\s))({_WORD}(?:\s{_WORD}){{0,2}})"),
}
#: What a text must hold for a kind to be looked for.
NEEDS = {"email": ("@",), "url_password": ("://",), "aws_key": ("AKIA", "ASIA"), "secret": ("=", ":")}
DIGITS = {"iban": 8, "card": 13, "ip": 4, "ssn": 9, "phone": 9}
WORD = re.compile(_WORD)
NEXT = re.compile(rf"[^\S\n]({_WORD})")
_DOTS = str.maketrans("İı", "ii")
DIGIT = re.compile(r"\d")


def _folded(text: str) -> str:
    """Without case, as patterns that ignore it see a text."""
    return text.translate(_DOTS).casefold()


#: Words that begin a name, without case: all that the person pattern takes for a title, and the given names.
NAMED = frozenset(_folded(w) for w in MALE | FEMALE | NEUTRAL | GIVEN_MALE | GIVEN_FEMALE if w != "m")


def _luhn(digits: str) -> int:
    """Check digit that ``digits`` needs behind it."""
    total = sum(sum(divmod(2 * int(d), 10)) if k % 2 == 0 else int(d) for k, d in enumerate(reversed(digits)))
    return -total % 10


def _ascii_digits(text: str) -> str:
    return "".join(str(unicodedata.decimal(c)) for c in text if c.isdecimal())


def _iban_rest(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


def _capital(word: str) -> bool:
    return word[:1].isupper()


def _people(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Names behind a title, or a known given name with a capitalised word behind it; each word is an entity."""
    at = 0
    pattern = PATTERNS["person"]
    while found := pattern.search(text, at):
        title, words = (found[1] or "").lower(), [(m.start() + found.start(3), m[0]) for m in re.finditer(_WORD, found[3])]
        line = text.find("\n", found.start(), found.end())
        if line >= 0:
            words = [w for w in words if w[0] < line]
        run = []
        for start, word in words:
            if not _capital(word):
                break
            run.append((start, word))
        if run and len(run) == len(words) and line < 0:
            # a name may have any number of words; behind the third, a word in capitals ends it
            while (more := NEXT.match(text, run[-1][0] + len(run[-1][1]))) and _capital(more[1]) and not (len(more[1]) > 1 and more[1].isupper()):
                run.append((more.start(1), more[1]))
        first = run[0][1].lower() if run else ""
        gender = "m" if title in MALE or not title and first in GIVEN_MALE else "f" if title in FEMALE or not title and first in GIVEN_FEMALE else "n"
        known = first in GIVEN_MALE | GIVEN_FEMALE
        if run and (title or known and len(run) > 1):
            if gender == "n" and known:
                gender = "m" if first in GIVEN_MALE else "f"
            given = len(run) > 1 or known
            for k, (start, word) in enumerate(run):
                yield start, start + len(word), f"given_{gender}" if given and k < max(1, len(run) - 1) else "family", word.casefold()
            at = run[-1][0] + len(run[-1][1])
        else:
            # nobody: go on behind the first word, or behind the title
            at = found.end(1) if title else max(found.start() + 1, found.end(2) if found[2] else 0)


def phone_name(value: str, digits: str) -> str:
    """The digits, behind a plus if the number has a country code; that of North America, which is often left out, goes."""
    if not value.startswith("+"):
        return digits
    return digits[1:] if len(digits) == 11 and digits[0] == "1" else "+" + digits


class _Taken:
    """Spans without overlaps, in order."""

    def __init__(self):
        self.begins: list[int] = []
        self.ends: list[int] = []

    def add(self, begin: int, end: int) -> bool:
        """Take a span unless a part of it is taken."""
        at = bisect_left(self.ends, begin + 1)
        if at < len(self.begins) and self.begins[at] < end:
            return False
        self.begins.insert(at, begin)
        self.ends.insert(at, end)
        return True


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, canonical form) of the mentions, without overlaps; the earlier kind of PATTERNS wins."""
    out: list[tuple[int, int, str, str]] = []
    taken = _Taken()
    digits = len(DIGIT.findall(text))
    for kind, pattern in PATTERNS.items():
        if digits < DIGITS.get(kind, 0) or kind in NEEDS and not any(x in text for x in NEEDS[kind]):
            continue
        if kind == "person":
            if not NAMED.isdisjoint(_folded(" ".join(set(WORD.findall(text)))).split(" ")):
                out += [m for m in _people(text) if taken.add(m[0], m[1])]
            continue
        for m in pattern.finditer(text):
            group = 1 if kind == "secret" else 0
            begin, end = m.span(group)
            value = m[group]
            plain = _ascii_digits(value)
            if kind == "email":
                name = value.lower()
            elif kind == "card":
                if not 13 <= len(plain) <= 19 or _luhn(plain[:-1]) != int(plain[-1]) or len(set(plain)) == 1:
                    continue
                name = plain
            elif kind == "ip":
                if any(int(p) > 255 or len(p) > 1 and p[0] == "0" for p in value.split(".")):
                    continue
                name = plain and value
            elif kind == "iban":
                tight = value.replace(" ", "")
                if not 15 <= len(tight) <= 34 or _iban_rest(tight[:2], tight[4:]) != int(tight[2:4]):
                    continue
                name = tight
            elif kind == "phone":
                if not 9 <= len(plain) <= 15:
                    continue
                name = phone_name(value, plain)
            elif kind == "ssn":
                name = plain
            else:
                name = value
            if taken.add(begin, end):
                out.append((begin, end, kind, name))
    return sorted(out)


class Draw:
    """Numbers that the key, the entity and the attempt decide."""

    def __init__(self, key: bytes, kind: str, name: str, attempt: int):
        self.seed, self.used, self.pool = (key, f"{kind}\0{name}\0{attempt}".encode()), 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            block = hashlib.blake2b(self.seed[1] + self.used.to_bytes(4, "big"), key=hashlib.sha256(self.seed[0]).digest(), digest_size=64).digest()
            self.pool, self.used = self.pool << 512 | int.from_bytes(block, "big"), self.used + 1
        self.pool, value = divmod(self.pool, n)
        return value

    def like(self, text: str) -> str:
        """Another text of the same shape: letters for letters of the same case and script, digits for digits."""
        hexadecimal = len(text) >= 8 and not set(text) - set("0123456789abcdef") and not text.isdecimal()
        out = []
        for c in text:
            if hexadecimal:
                out.append("0123456789abcdef"[self.below(16)])
            elif c.isdecimal():
                out.append(chr(ord(c) - unicodedata.decimal(c) + self.below(10)))
            elif c.isalpha():
                out.append(self.letter(c))
            else:
                out.append(c)
        return "".join(out)

    def letter(self, c: str) -> str:
        letters = next((a for a in ALPHABETS if c.lower() in a), ALPHABETS[0] if c.isascii() else None)
        if letters is None:
            # other scripts: a letter nearby that the same block has
            base = ord(c) & ~0x1F
            near = [chr(base + k) for k in range(32) if chr(base + k).isalpha() and chr(base + k).isupper() == c.isupper()]
            return near[self.below(len(near))] if near else c
        new = letters[self.below(len(letters))]
        return new.upper() if c.isupper() else new

    def longer(self, text: str, letters: int) -> str:
        """``like`` of a text with some letters behind it."""
        return self.like(text) + "".join(ALPHABETS[0][self.below(26)] for _ in range(letters))

    def name(self, kind: str, like: str, more: int = 0) -> str:
        """A name in the script of ``like``, of syllables, with an ending that shows its gender."""
        script = next((s for s in SYLLABLES if any(c in s[0] + s[1] for c in unicodedata.normalize("NFD", like.lower()))), SYLLABLES[0])
        consonants, vowels, endings = script
        body = "".join(consonants[self.below(len(consonants))] + vowels[self.below(len(vowels))] for _ in range(2 + more + self.below(2)))
        return body + consonants[self.below(len(consonants))] + endings[{"given_f": 0, "given_m": 1}.get(kind, 2)]


# Letters that replace letters, and what names are made of in each script (endings: female, male, family).
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω")
SYLLABLES = (
    ("bdfgklmnprstvz", "aeiou", ("a", "o", "er")),
    ("бвгдзклмнпрст", "аеиоу", ("а", "", "ов")),
    ("βγδζκλμνπρστ", "αειο", ("α", "ος", "ης")),
)


def surrogate(key: bytes, kind: str, name: str, attempt: int = 0) -> str:
    """The canonical form of the entity that stands for another one of the same kind.

    After CLASHES draws text grows by a letter or syllable a draw, and numbers of a fixed length come from wider ranges.
    """
    draw = Draw(key, kind, name, attempt)
    more = max(0, attempt - CLASHES + 1)
    if kind == "email":
        local, _, domain = name.rpartition("@")
        labels = domain.split(".")
        end = labels[-1] if labels[-1] in ("com", "org", "net") else "com"
        # one domain has one surrogate, whatever stands before it
        host = Draw(key, "domain", domain, 0).like(labels[0])
        return f"{draw.longer(local, more)[-64:]}@{host}.example.{end}"
    if kind == "card":
        body = name[0] + "".join(str(draw.below(10)) for _ in name[1:-1])
        return body + str(_luhn(body))
    if kind == "ip":
        parts = [int(x) for x in name.split(".")]
        fixed = 1 if parts[0] in (10, 127) else 2 if parts[:2] == [192, 168] or parts[0] == 172 and 16 <= parts[1] < 32 else 0
        if more > 16:  # any address
            return ".".join(str(draw.below(256)) for _ in parts)
        if more > 4:  # the reserved block, larger than all private ones
            parts, fixed = [240 + draw.below(16), *parts[1:]], 1
        elif more and fixed == 2:  # the largest private range
            parts, fixed = [10, *parts[1:]], 1
        new = parts[:fixed] + [draw.below(254) + 1 for _ in parts[fixed:]]
        if not fixed:
            new[0] = [x for x in range(11, 224) if x not in (127, 172, 192)][draw.below(210)]
        return ".".join(map(str, new))
    if kind == "iban":
        rest = draw.like(name[4:])
        return f"{name[:2]}{_iban_rest(name[:2], rest):02d}{rest}"
    if kind == "phone" and len(name) == 10:
        middle = "555" if name[3:6] == "555" and attempt < 8 else f"{draw.below(8) + 2}{draw.below(100):02d}"
        return f"{draw.below(8) + 2}{draw.below(100):02d}{middle}{draw.below(10000):04d}"
    if kind == "ssn":
        if more > 16:  # any number; before, areas that are never issued
            return f"{draw.below(10**9):09d}"
        return f"9{draw.below(100):02d}{draw.below(99) + 1:02d}{draw.below(9999) + 1:04d}"
    if kind == "aws_key":
        return name[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draw.below(32)] for _ in name[4:])
    if kind.startswith(("given", "family")):
        return draw.name(kind, name, more)
    if kind == "phone" and name[0] == "+":  # the country code stays
        kept = max(3, len(name) - 10)
        return name[:kept] + draw.like(name[kept:])
    return draw.like(name) if kind == "phone" else draw.longer(name, more)


def written(kind: str, mention: str, new: str) -> str:
    """The surrogate in the format of a mention: its separators, digits' script and case."""
    if kind in ("card", "phone", "ssn"):
        new = new.lstrip("+")
        places = [k for k, c in enumerate(mention) if c.isdecimal()][-len(new) :]
        out = list(mention)
        for place, digit in zip(places, new):
            out[place] = chr(ord(mention[place]) - unicodedata.decimal(mention[place]) + int(digit))
        return "".join(out)
    if kind == "iban":
        rest = iter(new)
        return "".join(c if c == " " else next(rest) for c in mention)
    if kind.startswith(("given", "family")):
        return new.upper() if mention.isupper() and len(mention) > 1 else new[:1].upper() + new[1:]
    if kind == "email" and mention.isupper():
        return new.upper()
    return new


MENTION = "array<struct<begin:int,end:int,kind:string,name:string>>"


def _mentions(df: DataFrame, id_column: str, column: str) -> DataFrame:
    """Stored (id, hash, mentions) of the texts that have any."""
    kept = df.where(F.col(column).isNotNull()).select(F.col(id_column).alias("id"), F.xxhash64(column).alias("hash"), F.col(column).alias("text"))
    mention = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("name", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_entities(t) for t in batch.column(2).to_pylist()]
            keep = [k for k, f in enumerate(found) if f]
            rows = batch.take(pa.array(keep, pa.int64()))
            lists = [[dict(zip(("begin", "end", "kind", "name"), m)) for m in found[k]] for k in keep]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(lists, mention)], names=["id", "hash", "mentions"])

    return materialize(kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, hash long, mentions {MENTION}"))


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, name, surrogate) of the distinct entities, none of them shared and none an entity itself.

    Given and family names are one kind here, so that no name stands for two. An entity keeps its
    surrogate if it has the earliest draw of it, ties by name; the others draw again.
    """

    def draw(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                new = [surrogate(key, k, n, a) for k, n, a in zip(*(batch.column(i).to_pylist() for i in range(3)))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=["kind", "name", "attempt", "surrogate"])

        return df.mapInArrow(run, "kind string, name string, attempt int, surrogate string")

    family = F.when(F.col("kind").rlike("^(given|family)"), "person").otherwise(F.col("kind"))
    real = entities.select(family.alias("group"), F.lower("name").alias("low")).distinct()
    drawn = materialize(draw(entities.select("kind", "name", F.lit(0).alias("attempt"))))
    for _ in range(DRAWS):
        named = drawn.withColumn("group", family).withColumn("low", F.lower("surrogate"))
        owner = named.groupBy("group", "low").agg(F.min(F.struct("attempt", "name", "kind")).alias("owner"))
        judged = named.join(owner, ["group", "low"]).join(real.withColumn("real", F.lit(True)), ["group", "low"], "left")
        clash = F.col("real").isNotNull() | (F.col("owner") != F.struct("attempt", "name", "kind"))
        judged = judged.select("kind", "name", "attempt", "surrogate", clash.alias("clash"))
        again = materialize(judged.where("clash").select("kind", "name", (F.col("attempt") + 1).alias("attempt")))
        if again.isEmpty():
            return drawn.select("kind", "name", "surrogate")
        drawn = materialize(judged.where("NOT clash").drop("clash").unionByName(draw(again)))
    raise RuntimeError("entities left without a surrogate of their own")


def replace(df: DataFrame, key: bytes, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """``df`` with the entities in ``column`` replaced, and ``pii`` (kind, begin and end in characters of each mention).

    Null texts stay null and texts without entities stay as they are, with an empty list. Rows of
    equal id and text are one document. Documents are joined to their replacements by id and
    hash, so a name that a third of them mentions is looked up row by row. A column ``pii`` is replaced.
    """
    base = df.drop("pii")
    found = _mentions(base, id_column, column)
    mentions = found.dropDuplicates(["id", "hash"]).select("id", "hash", F.inline("mentions"))
    entities = materialize(mentions.select("kind", "name").distinct())
    chosen = assign(entities, key)
    lists = mentions.join(chosen, ["kind", "name"]).groupBy("id", "hash").agg(F.array_sort(F.collect_list(F.struct("begin", "end", "kind", "surrogate"))).alias("pii"))
    lists = lists.select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), "pii")
    whole = rows_of(base, column, id=id_column)
    joined = whole.join(lists, F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left").select("row", "text", "pii")
    listed = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kinds = as_bytes(batch.column(1)), []
            for k, own in enumerate(batch.column(2).to_pylist()):
                if own:
                    text, at, out = texts[k].decode(), 0, []
                    for m in own:
                        out += [text[at : m["begin"]], written(m["kind"], text[m["begin"] : m["end"]], m["surrogate"])]
                        at = m["end"]
                    texts[k] = "".join([*out, text[at:]]).encode()
                kinds.append([{x: m[x] for x in ("kind", "begin", "end")} for m in own or ()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(kinds, listed)], names=["row", "text", "pii"])

    schema = whole.select("row", "text", F.lit(None).cast("array<struct<kind:string,begin:int,end:int>>").alias("pii")).schema
    done = joined.mapInArrow(run, schema)
    return done.select(*columns_of(base.columns, column), "pii")
