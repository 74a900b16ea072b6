"""Personal data replaced by keyed surrogates of the same type and form.

Entities are found by pattern: e-mail addresses, telephone numbers, payment cards (16 digits in
fours, or 13 to 19 digits with a true check digit), IPv4 and IPv6 addresses, US social security
numbers, and names after a title.  Every entity (whatever its
spelling: letter case, spaces and punctuation do not matter) has one surrogate in the whole
corpus, so mentions stay coreferent; each mention keeps its own punctuation and letter case.
Numbers and addresses go through a keyed permutation of their letters and digits (a Feistel
network), names through keyed syllables of the same script.  Cards keep their network digit and
the truth of their check digit, telephone numbers their country code and first digit; a number
of the form 3-3-4 without a country code is one of country code 1.

The words of a name are entities of their own, so a surname alone is that of the full name.  A
given name, the first of two words, has an ending that fits the title's gender; after Dr or Prof
alone it goes with the same given name after another title, the female one first.  A word alone
after a title is a surname, unless the corpus has it only as a given name of that gender.

Distinctness is checked over the corpus: a surrogate that equals a real entity, or another's
surrogate, is drawn again until none is left.  Each new draw of a name has a syllable more in
every word, so the room for names grows until all have found a place.

How it scales: texts are scanned once, where they lie, and the places found are stored; the entity
table holds each entity once, with partial aggregation before its shuffle; collisions are found
by joins.

Defined results: NULL and empty texts stay as they are; texts without entities are unchanged;
repeated rows get equal texts; rows with a NULL id take part; of overlapping matches the longer,
then the earlier kind counts; other columns pass through, ``n_chars`` follows the text.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import ipaddress
import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import arrow_map, free_name, stored

KEY = b"change this key in production"
ROUNDS = 8
_MALE = "Mr Sir Herr Monsieur Señor Don Господин Κύριος".split()
_FEMALE = "Mrs Ms Miss Madam Frau Madame Mademoiselle Señora Señorita Doña Госпожа Κυρία".split()
_LEARNED = "Dr Prof Doctor Professor".split()
_NAME = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))+"
PATTERNS = (
    ("card", re.compile(r"(?<![\w.-])[3-6]\d{3}([ -]?)\d{4}\1\d{4}\1\d{4}(?![\w-])")),
    ("card", re.compile(r"(?<![\w.-])(?:[1-9]\d{12,18}|[1-9]\d{3}([ -])(?:\d{4}\1\d{4}\1\d{1,4}(?:\1\d{1,3})?|\d{6}\1\d{4,5}|\d{3}\1\d{3}\1\d{3})|[1-9]\d{5}[ -]\d{13}|[1-9]\d{7}[ -]\d{8,11})(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)|(?<![\w.])\+\d{1,3}[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){2,3}(?!\w)")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("ip", re.compile(r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\w]|\.\d)")),
    ("ip6", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}(?:(?:\d{1,3}\.){3}\d{1,3}|[0-9A-Fa-f]{0,4})(?!\w|:[0-9A-Fa-f:]|\.\d)")),
)
# E-mail addresses are read from their @ outwards, so a long word is passed over once.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
# FIXED VALUES: country codes of one and two digits; all others have three.
_SHORT_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
_TWO_COLONS = re.compile(r":[0-9A-Fa-f]{0,4}:")
_ANY_16 = PATTERNS[0][1]  # cards that count whatever their check digit
_TITLES, _LEARNED_TITLES = "|".join(_MALE + _FEMALE), rf"(?:(?:{'|'.join(_LEARNED)})\.? )"
# "Don" and "Sir" after a learned title may be names themselves.
_AFTER = "|".join(t for t in _MALE + _FEMALE if t not in ("Don", "Sir"))
_TITLED = re.compile(rf"(?<!\w)(?:({_TITLES})\.? {_LEARNED_TITLES}{{0,4}}|{_LEARNED_TITLES}{{1,4}}(?:({_AFTER})\.? )?{_LEARNED_TITLES}{{0,4}})({_NAME}(?: {_NAME})?)")
_SYLLABLES = {
    "LATIN": ("b d f g k l m n p r s t v".split(), "a e i o u".split(), "n", "na"),
    "CYRILLIC": ("б в г д к л м н п р с т".split(), "а е и о у".split(), "н", "на"),
    "GREEK": ("β γ δ κ λ μ ν π ρ σ τ".split(), "α ε ι ο υ".split(), "ς", "να"),
}


def _draw(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.new(key, "\0".join(map(str, parts)).encode(), hashlib.sha256).digest()[:16])


def permuted(values: list[int], base: int, key: bytes, *tweak: object) -> list[int]:
    """A keyed permutation of all sequences of this length over ``base`` symbols."""
    if len(values) == 1:
        return [(values[0] + _draw(key, base, *tweak)) % base]
    half = len(values) // 2
    a, b = values[:half], values[half:]

    def number(x: list[int]) -> int:
        out = 0
        for d in x:
            out = out * base + d
        return out

    x, y = number(a), number(b)
    for r in range(ROUNDS):
        if r % 2:
            y = (y + _draw(key, base, r, x, *tweak)) % base ** len(b)
        else:
            x = (x + _draw(key, base, r, y, *tweak)) % base ** len(a)

    def digits(n: int, size: int) -> list[int]:
        out = []
        for _ in range(size):
            n, d = divmod(n, base)
            out.append(d)
        return out[::-1]

    return digits(x, len(a)) + digits(y, len(b))


def _spelled(text: str, key: bytes, *tweak: object) -> str:
    """Lower-case letters and digits permuted within their places."""
    shape = "".join("a" if c.isalpha() else "0" if c.isdigit() else c for c in text)
    letters, digits = [ord(c) - 97 for c in text if c.isalpha()], [int(c) for c in text if c.isdigit()]
    if digits:
        digits = permuted(digits, 10, key, "digits", shape, *letters, *tweak)
    if letters:
        letters = permuted(letters, 26, key, "letters", shape, *tweak)
    a, d = iter(letters), iter(digits)
    return "".join(chr(97 + next(a)) if c == "a" else str(next(d)) if c == "0" else c for c in shape)


def _check_digit(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _is_real(kind: str, mention: str) -> bool:
    """Whether what looks like a card or an IPv6 address can be one."""
    if kind == "card" and not _ANY_16.fullmatch(mention):
        digits = "".join(c for c in mention if c.isdigit())
        return 13 <= len(digits) <= 19 and int(digits[-1]) == _check_digit(digits[:-1])
    if kind == "ip6":
        if not any(c.isdigit() for c in mention) and mention.count(":") < 3:
            return False  # a::b is more often code
        try:
            ipaddress.IPv6Address(mention)
        except ValueError:
            return False
    return True


def _script(letter: str) -> str:
    return unicodedata.name(letter, "LATIN").split(" ")[0]


@functools.cache
def _letters(first: str) -> list[str]:
    """Letters without capitals of the same script, from the 256 places around a letter."""
    start = ord(first) & ~0xFF
    near = [chr(c) for c in range(start, start + 256)]
    return [c for c in near if unicodedata.category(c) in ("Ll", "Lo") and _script(c) == _script(first)]


def _emails(text: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        while start < at and text[start] in "._%+-":
            start += 1
        domain = _DOMAIN.match(text, at + 1) if start < at and text[at - 1] != "." else None
        if domain:
            last = domain.end()
            out.append((start, last))
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def _telephone(mention: str) -> str:
    """Country code and number, whatever the separators."""
    digits = "".join(c for c in mention if c.isdigit())
    if not mention.startswith("+"):
        return f"1|{digits}"
    size = next((n for n in (1, 2) if digits[:n] in _SHORT_CODES), 3)
    return f"{digits[:size]}|{digits[size:]}"


def canonical(kind: str, mention: str) -> str:
    """What all mentions of one entity share."""
    if kind == "email":
        return mention.lower()
    if kind in ("card", "phone", "ssn"):
        return _telephone(mention) if kind == "phone" else "".join(c for c in mention if c.isdigit())
    if kind == "ip":
        return ".".join(str(int(x)) for x in mention.split("."))
    if kind == "ip6":
        return f"{int(ipaddress.IPv6Address(mention)):032x}"
    return " ".join(mention.casefold().split())


def surrogate(kind: str, entity: str, attempt: int, key: bytes = KEY) -> str:
    """The candidate for an entity, in the form that ``canonical`` gives."""
    if kind == "email":
        name, host = entity.split("@")
        *labels, last = host.split(".")
        return f"{_spelled(name, key, 'email', host, attempt)}@{'.'.join(_spelled(x, key, 'host', attempt) for x in labels)}.{last}"
    if kind == "card":
        middle = "".join(map(str, permuted([int(c) for c in entity[1:-1]], 10, key, "card", entity[0], attempt)))
        off = (int(entity[-1]) - _check_digit(entity[:-1])) % 10
        return f"{entity[0]}{middle}{(_check_digit(entity[0] + middle) + off) % 10}"
    if kind == "phone":
        code, rest = entity.split("|")
        return f"{code}|{rest[0]}" + "".join(map(str, permuted([int(c) for c in rest[1:]], 10, key, "phone", code, rest[0], attempt)))
    if kind == "ssn":
        return "".join(map(str, permuted([int(c) for c in entity], 10, key, "ssn", attempt)))
    if kind == "ip":
        octets = permuted([int(x) for x in entity.split(".")], 256, key, "ip", attempt)
        return ".".join(map(str, octets))
    if kind == "ip6":
        return "".join(f"{x:x}" for x in permuted([int(c, 16) for c in entity], 16, key, "ip6", attempt))
    gender, name = entity.split("|")
    return " ".join(_word(gender if place == 0 else "s", word, attempt, key) for place, word in enumerate(name.split(" ")))


def _word(role: str, word: str, attempt: int, key: bytes) -> str:
    """A word of a name: a given name of a gender, or a surname."""
    letter = next((c for c in word if c.isalpha()), "a")
    script = _script(letter)
    n, made = _draw(key, "name", script, role, word, attempt), ""
    if script not in _SYLLABLES and len(_letters(letter)) > 1:
        letters = _letters(letter)
        for _ in range(min(12, len(word)) + attempt):
            n, c = divmod(n, len(letters))
            made += letters[c]
        return made
    starts, vowels, male, female = _SYLLABLES.get(script, _SYLLABLES["LATIN"])
    for _ in range(max(1, min(6, len(word) // 2)) + attempt):  # each attempt has more room
        n, s = divmod(n, len(starts))
        n, v = divmod(n, len(vowels))
        made += starts[s] + vowels[v]
    return made + ("" if role == "s" else female if role == "f" else male)


def rendered(kind: str, mention: str, found: str) -> str:
    """A surrogate in the punctuation and letter case of a mention."""
    if kind == "email":
        return "".join(c.upper() if m.isupper() else c for c, m in zip(found, mention, strict=True))
    if kind == "ip":
        return found
    if kind == "ip6":
        groups = [found[i : i + 4] for i in range(0, 32, 4)]
        shown = ":".join(groups if len(mention) == 39 else (f"{int(g, 16):x}" for g in groups))
        return shown.upper() if any(c.isupper() for c in mention) else shown
    if kind == "name":
        words = found.split(" ")
        return " ".join(w.upper() if m.isupper() and len(m) > 1 else w[0].upper() + w[1:] if m[0].isupper() else w for w, m in zip(words, mention.split(" "), strict=True))
    if kind == "phone" and not mention.startswith("+"):
        found = found.split("|")[1]
    digits = iter(found.replace("|", ""))
    return "".join(next(digits) if c.isdigit() else c for c in mention)


def _may_start(letter: str) -> bool:
    """Capitals, and letters of scripts without them."""
    return letter.isupper() or letter == letter.title()


def mentions(text: str | None) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and entity of every mention, in order, without overlaps."""
    if not text:
        return []
    found = [(a, b, -1, "email", canonical("email", text[a:b])) for a, b in _emails(text)]
    for order, (kind, pattern) in enumerate(PATTERNS):
        if kind == "ip6" and not _TWO_COLONS.search(text):
            continue
        found += [(m.start(), m.end(), order, kind, canonical(kind, m.group())) for m in pattern.finditer(text) if _is_real(kind, m.group())]
    for m in _TITLED.finditer(text):
        words = m.group(3).split(" ")
        if _may_start(words[0][0]) and words[0] not in _LEARNED:
            take = m.group(3) if len(words) > 1 and _may_start(words[1][0]) else words[0]
            title = m.group(1) or m.group(2)
            gender = "n" if title is None else "m" if title in _MALE else "f"
            found.append((m.start(3), m.start(3) + len(take), 9, "name", f"{gender}|{canonical('name', take)}"))
    found.sort(key=lambda x: (x[0] - x[1], x[2], x[0]))
    starts: list[int] = []  # of what is taken, ascending, with the ends beside them
    ends: list[int] = []
    out: list[tuple[int, int, str, str]] = []
    for a, b, _, kind, entity in found:
        at = bisect_right(starts, a)
        if (at == 0 or ends[at - 1] <= a) and (at == len(starts) or starts[at] >= b):
            starts.insert(at, a)
            ends.insert(at, b)
            out.append((a, b, kind, entity))
    return sorted(out)


def parts(text: str, mention: tuple[int, int, str, str]) -> list[tuple[int, int, str, str]]:
    """A mention as its entities: the words of a name are one each.

    Roles: ``m``, ``f`` and ``n`` are given names by the title's gender, ``s`` surnames; a word
    alone has the capital of its title's gender until the corpus tells what it is.
    """
    start, end, kind, entity = mention
    if kind != "name":
        return [mention]
    gender, words = entity[0], text[start:end].split(" ")
    roles = [gender.upper()] if len(words) == 1 else [gender, "s"]
    out = []
    for role, word in zip(roles, words, strict=True):
        out.append((start, start + len(word), kind, f"{role}|{canonical('name', word)}"))
        start += len(word) + 1
    return out


_PLACES = "mark long, start int, end int, kind string, entity string, mention string, counts int"


def located(docs: DataFrame) -> DataFrame:
    """Stored places of all entities in the texts of ``docs`` (``mark``, ``text``); ``counts`` is 1 where a mention begins."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = {
                (m, a, b, kind, entity, text[a:b], int(i == 0))
                for m, text in zip(batch.column("mark").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for mention in mentions(text)
                for i, (a, b, kind, entity) in enumerate(parts(text, mention))
            }
            columns = list(zip(*sorted(rows), strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["mark", "start", "end", "kind", "entity", "mention", "counts"])

        return step

    return stored(arrow_map(docs.select("mark", "text"), make, _PLACES), "pii-places")


def _resolved(places: DataFrame) -> DataFrame:
    """Each entity with the one it goes with, ``same_as``, and how that one is ``shown``."""
    known = places.select("kind", "entity").distinct()
    names = known.where("kind = 'name'").select("entity", F.substring_index("entity", "|", 1).alias("role"), F.substring_index("entity", "|", -1).alias("shown"))
    has = names.groupBy("shown").agg(*[F.max((F.col("role") == r).cast("int")).alias(f"has_{r}") for r in "smfn"])
    role = F.expr("""
        CASE WHEN role IN ('s', 'm', 'f') THEN role
             WHEN role = 'n' THEN CASE WHEN has_f = 1 THEN 'f' WHEN has_m = 1 THEN 'm' ELSE 'n' END
             WHEN has_s = 1 THEN 's'
             WHEN role = 'M' AND has_m = 1 THEN 'm'
             WHEN role = 'F' AND has_f = 1 THEN 'f'
             WHEN role = 'N' AND has_f = 1 THEN 'f'
             WHEN role = 'N' AND has_m = 1 THEN 'm'
             WHEN role = 'N' AND has_n = 1 THEN 'n'
             ELSE 's' END""")
    resolved = names.join(has, "shown").select(F.lit("name").alias("kind"), "entity", F.concat(role, F.lit("|"), "shown").alias("same_as"), "shown")
    return resolved.unionByName(known.where("kind <> 'name'").select("kind", "entity", F.col("entity").alias("same_as"), F.col("entity").alias("shown")))


def assigned(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``kind``, ``entity``, ``surrogate`` of the entities in ``docs``."""
    return assigned_places(located(docs.select(row_mark().alias("mark"), "text")), key)


def assigned_places(places: DataFrame, key: bytes = KEY) -> DataFrame:
    """``kind``, ``entity``, ``surrogate``: one row per entity; no surrogate is real or used twice."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = zip(batch.column("kind").to_pylist(), batch.column("entity").to_pylist(), batch.column("attempt").to_pylist(), strict=True)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array([surrogate(k, e, a, key) for k, e, a in rows], pa.string())], names=[*batch.schema.names, "surrogate"])

        return step

    entities = stored(_resolved(places), "pii-entities")
    real = entities.select("kind", F.col("shown").alias("surrogate")).distinct()
    open_rows, done, attempt = entities.select("kind", F.col("same_as").alias("entity")).distinct(), None, 0
    while True:
        drawn = arrow_map(open_rows.withColumn("attempt", F.lit(attempt)), make, "kind string, entity string, attempt int, surrogate string")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("winner")).join(real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            first = first.join(done, ["kind", "surrogate"], "left_anti")
        judged = stored(drawn.join(first, ["kind", "surrogate"], "left").select("kind", "entity", "surrogate", (F.col("winner") == F.col("entity")).alias("won")), "pii-drawn")
        won = judged.where("won").select("kind", "entity", "surrogate")
        done = won if done is None else done.unionByName(won)
        open_rows = judged.where("won IS NULL OR NOT won").select("kind", "entity")
        if open_rows.isEmpty():
            return entities.join(done.withColumnRenamed("entity", "same_as"), ["kind", "same_as"]).select("kind", "entity", "surrogate")
        attempt += 1


def row_mark() -> Column:
    return F.xxhash64("doc_id", "text")


def replace(docs: DataFrame, key: bytes = KEY, count: str | None = None) -> DataFrame:
    """``docs`` with every mention replaced; ``count`` names a column for their number."""
    mark, list_name = free_name(docs, "row_mark"), free_name(docs, "replacements")
    places = located(docs.select(row_mark().alias("mark"), "text"))
    names = assigned_places(places, key)

    def render():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            new = [rendered(r["kind"], r["mention"], r["surrogate"]) for r in batch.to_pylist()]
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("mark", "start", "end", "counts")), pa.array(new, pa.string())], names=["mark", "start", "end", "counts", "new"])

        return step

    shown = places.distinct().join(names, ["kind", "entity"]).select("mark", "start", "end", "counts", "kind", "mention", "surrogate")
    new_parts = arrow_map(shown, render, "mark long, start int, end int, counts int, new string")
    lists = new_parts.groupBy("mark").agg(F.sort_array(F.collect_list(F.struct("start", "end", "counts", "new"))).alias(list_name)).withColumnRenamed("mark", mark)
    joined = docs.withColumn(mark, row_mark()).join(lists, mark, "left")
    # Texts meet their replacements without leaving the JVM.
    found, text = F.col(list_name), F.col("text")
    nothing = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(done: Column, f: Column) -> Column:
        gap = text.substr(done["at"] + 1, f["start"] - done["at"])
        return F.struct(f["end"].alias("at"), F.concat(done["out"], gap, f["new"]).alias("out"))

    new = F.aggregate(found, nothing, put, lambda done: F.concat(done["out"], text.substr(done["at"] + 1, F.lit(2**31 - 1))))
    columns = []
    for f in docs.schema.fields:
        if f.name == "text":
            columns.append(F.when(found.isNull(), text).otherwise(new).alias("text"))
        elif f.name == "n_chars":
            columns.append(F.when(found.isNull(), F.col("n_chars")).otherwise(F.char_length(new)).cast(f.dataType).alias("n_chars"))
        elif f.name != count:
            columns.append(F.col(f"`{f.name}`"))
    if count:
        total = F.aggregate(found, F.lit(0), lambda n, f: n + f["counts"])
        columns.append(F.coalesce(total, F.lit(0)).cast("long").alias(count))
    return joined.select(*columns)
