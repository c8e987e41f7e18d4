"""Surrogates for personal data: keyed, of the same type and format, distinct and coreferent.

Detected kinds: e-mail and IP addresses, phone, card and social security numbers, IBANs, secrets that are
assigned to a telling name, and names of persons behind a title, with their other mentions in the same
document, before or after, whose words begin with a capital. Each entity is first brought to a normal value (case,
separators and country code do not make another entity), and the surrogate depends on the key, the kind and
this value alone, so an entity has one surrogate wherever and however it is written.

The kind of a given name holds the gender that the titles of the person tell anywhere in the document or, if they tell none
there, in all documents that name this person behind a title (and agree). So ``Dr Anna Weber`` is renamed as
``Mrs Anna Weber`` is, in one document and across documents. Where two persons of a document share a given
name, a mention by it alone belongs to the one named last. A word that is a name in a document counts as one
wherever it is capitalised there.

Numbers, addresses and secrets go through a keyed permutation of all strings of their format, so distinct
values cannot meet: digits stay digits, letters stay letters of their script and case, a card number keeps
whether its check digit holds, an IP address whether it is private, public or reserved. Names become invented names of the same
script, with endings that suit the gender of the title, given and family names apart.

All distinct entities are then checked together: if two share a surrogate, or a surrogate is an entity that
occurs in the documents, the later one (by value) tries its next surrogate, until none collide. An invented name gets a
syllable longer with each try, so names never run out. The few
entities that needed another try are looked up per document; all others are derived in place.

Defined results: NULL texts stay NULL and empty ones empty; a text without entities is unchanged; repeated
rows stay and are rewritten alike; rows that share a doc_id, or have none, are rewritten each by itself, known by id
and a hash of the text; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfprice.plans.joins import attach_groups
from shelfprice.plans.staging import stage

MAX_ROUNDS = 64
# Surrogates that a task remembers.
REMEMBERED = 1 << 16
# (first and last word of a name) to the gender that other documents tell.
Genders = dict[tuple[str, str], str]

# --- detection -----------------------------------------------------------------------------------

# All of these lie within a line that has one of the characters of _SIGN.
_SIGN = re.compile(r"[0-9@=:]")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_FOUND = re.compile(
    r"(?P<email>[A-Za-z0-9._%+\-]+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,})"
    r"|(?:token|api[_\-]?key|secret|password|passwd|pwd)[ \t]*[=:][ \t]*[\"']?(?P<secret>[A-Za-z0-9+/_\-]{8,}=*)"
    r"|(?<![0-9A-Za-z])(?P<iban>[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?![0-9A-Za-z])"
    rf"|(?<![0-9A-Za-z.])(?P<ip>(?:{_OCTET}\.){{3}}{_OCTET})(?!\.?[0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])(?P<ssn>\d{3}-\d{2}-\d{4})(?![0-9A-Za-z\-])"
    r"|(?<![0-9A-Za-z])(?P<card>\d(?:[ \-]?\d){12,18})(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])(?P<phone>\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}"
    r"|\(\d{3}\)[ ]?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?![0-9A-Za-z])",
    re.IGNORECASE,
)

# Titles and the gender they tell; '' where they tell none.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "Госпожа": "f",
    "Κυρία": "f", "Dr": "", "Prof": "",
}
_TITLE_FORMS = [form for t in TITLES for form in {t, t.upper()}]
_GENDER = {t.casefold(): g for t, g in TITLES.items()}
_ANY_TITLE = "(?:" + "|".join(sorted(map(regex.escape, _TITLE_FORMS), key=len, reverse=True)) + r")(?!\w)"
# A word of a name; neither a title nor the ending of a genitive belongs to it.
_NAME = rf"(?!{_ANY_TITLE})\p{{Lu}}(?:\p{{L}}|'(?=\p{{L}})(?!s(?!\w)))+"
_PERSON = regex.compile(rf"(?<!\w)(?:(?P<title>{_ANY_TITLE})\.?[ \t]+)+(?P<name>{_NAME}(?:[ \-]{_NAME}){{0,3}})")
_NAME_WORD = regex.compile(rf"(?<!\w){_NAME}(?!\w)")


def _lines_with(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    """Ranges of the lines in which ``pattern`` occurs."""
    at = 0
    while hit := pattern.search(text, at):
        start = text.rfind("\n", 0, hit.start()) + 1
        end = text.find("\n", hit.end())
        end = len(text) if end < 0 else end
        yield start, end
        at = end


def _normal(kind: str, found: str) -> str:
    if kind in ("email", "iban"):
        return found.lower().replace(" ", "")
    if kind == "secret":
        return found.lower() if found in (found.lower(), found.upper()) else found
    if kind == "phone":
        return "".join(filter(str.isdigit, _national(found)))
    if kind in ("card", "ssn"):
        return "".join(filter(str.isdigit, found))
    return found


def _national(phone: str) -> str:
    """A phone number without its country code."""
    code = re.match(r"\+\d{1,3}(?=[ .\-(])", phone)
    return phone[code.end() :] if code else phone


def entities(text: str, told_elsewhere: Genders | None = None) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, normal value)`` of all entities, in order and without overlap."""
    found = []
    for start, end in _lines_with(_SIGN, text):
        for m in _FOUND.finditer(text, start, end):
            kind = m.lastgroup
            a, b = m.span(kind)
            found.append((a, b, kind, _normal(kind, text[a:b])))
    if any(form in text for form in _TITLE_FORMS):
        titled, bare = _persons(text, told_elsewhere or {})
        found += titled
        found.sort()
        found = [x for i, x in enumerate(found) if i == 0 or x[0] >= max(y[1] for y in found[max(0, i - 8) : i])]
        ends = [x[1] for x in found]
        # A mention is taken if the first entity that ends behind its start begins behind it.
        after = [bisect_right(ends, x[0]) for x in bare]
        free = [x for x, i in zip(bare, after, strict=True) if i == len(found) or found[i][0] >= x[1]]
        found = sorted(found + free)
    return found


People = list[tuple[str, list[tuple[int, int, str]]]]


def _people(text: str) -> People:
    """Per name behind titles: the gender that these tell, and its words with their places."""
    people = []
    for m in _PERSON.finditer(text):
        gender = next(filter(None, (_GENDER[t.casefold()] for t in m.captures("title"))), "")
        at = m.start("name")
        people.append((gender, [(at + p.start(), at + p.end(), p[0].casefold()) for p in regex.finditer(r"[\p{L}']+", m["name"])]))
    return people


def _told(people: People) -> dict[tuple[str, str], set[str]]:
    """Genders by person (first and last word of the name), and of a given name that stands alone."""
    givens = {w for _, parts in people for _, _, w in parts[:-1]}
    families = {parts[-1][2] for _, parts in people if len(parts) > 1}
    genders: dict[tuple[str, str], set[str]] = defaultdict(set)
    for gender, parts in people:
        first, last = parts[0][2], parts[-1][2]
        if gender and len(parts) > 1:
            genders[first, last].add(gender)
        elif gender and last in givens and last not in families:
            genders[last, ""].add(gender)
    return genders


def persons(text: str) -> set[tuple[str, str, str]]:
    """``(first, last, gender)`` of the full names behind titles, with '' where the text tells no gender."""
    if not any(form in text for form in _TITLE_FORMS):
        return set()
    people = _people(text)
    genders = _told(people)
    full = {(parts[0][2], parts[-1][2]) for _, parts in people if len(parts) > 1}
    return {(*name, g) for name in full for g in genders.get(name) or genders.get((name[0], "")) or {""}}


def _persons(text: str, told_elsewhere: Genders) -> tuple[list[tuple[int, int, str, str]], list[tuple[int, int, str, str]]]:
    """Words of names behind titles, and words of the same names elsewhere, as ``entities`` has them."""
    people = _people(text)
    givens = {w for _, parts in people for _, _, w in parts[:-1]}
    families = {parts[-1][2] for _, parts in people if len(parts) > 1}
    genders = _told(people)
    for name in {(parts[0][2], parts[-1][2]) for _, parts in people if len(parts) > 1}:
        if name in told_elsewhere and not genders.get(name) and not genders.get((name[0], "")):
            genders[name].add(told_elsewhere[name])

    def gender_of(first: str, last: str) -> str:
        told = genders.get((first, last)) or genders.get((first, ""), set())
        if not last:
            told = {g for (w, _), gs in genders.items() if w == first for g in gs}
        return next(iter(told)) if len(told) == 1 else ""

    titled = []
    known: dict[str, list[tuple[int, str]]] = defaultdict(list)
    full = {}
    for gender, parts in people:
        alone = len(parts) == 1 and parts[0][2] in givens and parts[0][2] not in families
        first, last = parts[0][2], "" if alone else parts[-1][2]
        given = "given_" + (gender or gender_of(first, last))
        if len(parts) > 1:
            full[first, last] = given
        for i, (a, b, word) in enumerate(parts):
            kind = given if alone or i < len(parts) - 1 else "family"
            titled.append((a, b, kind, word))
            known[word].append((a, kind))
    if not people:
        return [], []
    bare = []
    before = None  # the last bare mention and where it stands in the text
    for m in _NAME_WORD.finditer(text):
        word = m[0].casefold()
        mentions = known.get(word)
        if mentions is None:
            before = None
            continue
        i = bisect_right(mentions, (m.start(), "\uffff"))
        kind = mentions[max(0, i - 1)][1]
        if before and before[1] + 1 == m.start() and text[before[1]] in " -" and (before[3], word) in full:
            bare[-1] = (*before[:2], full[before[3], word], before[3])
            kind = "family"
        before = (m.start(), m.end(), kind, word)
        bare.append(before)
    return titled, bare


# --- surrogates ----------------------------------------------------------------------------------

_ALPHABETS = [
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
]
_CLASS = {c: a for a in _ALPHABETS for c in a}
_HEX = "0123456789abcdef"

# Syllables of invented names by script, and endings by gender.
_SYLLABLES = {
    "latin": "ba be da do ka ke la lo ma me na ne pa ra ri sa so ta te va vi".split(),
    "cyrillic": "ба бе да до ка ке ла ло ма ме на не па ра ри са со та те ва ви".split(),
    "greek": "βα βε δα δο κα κε λα λο μα με να νε πα ρα ρι σα σο τα τε βα βι".split(),
}
_ENDINGS = {
    "latin": {"given_f": "lia", "given_m": "ron", "given_": "ris", "family": "sky"},
    "cyrillic": {"given_f": "лия", "given_m": "рон", "given_": "рис", "family": "ский"},
    "greek": {"given_f": "λια", "given_m": "ρων", "given_": "ρις", "family": "δης"},
}
_SYLLABLES_IN_NAME = 5


def _draw(key: bytes, *parts: object) -> int:
    message = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(message, key=key, digest_size=16).digest(), "big")


def permuted(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of ``range(size)``: a Feistel network on the bits, walked until inside the range."""
    if size < 2:
        return value
    bits = max(2, (size - 1).bit_length())
    low = bits // 2
    high = bits - low
    while True:
        for turn in range(0, 10, 2):
            a, b = value >> low, value & ((1 << low) - 1)
            a ^= _draw(key, tweak, turn, b) & ((1 << high) - 1)
            b ^= _draw(key, tweak, turn + 1, a) & ((1 << low) - 1)
            value = a << low | b
        if value < size:
            return value


def _same_format(text: str, key: bytes, tweak: str, alphabets: list[str | None] | None = None) -> str:
    alphabets = alphabets or [_CLASS.get(c) for c in text]
    value, size = 0, 1
    for c, a in zip(text, alphabets, strict=True):
        if a:
            value, size = value * len(a) + a.index(c), size * len(a)
    pattern = "".join("." if a is None else a[0] for a in alphabets)
    value = permuted(value, size, key, f"{tweak}/{pattern}")
    out = []
    for c, a in zip(reversed(text), reversed(alphabets), strict=True):
        if a:
            value, digit = divmod(value, len(a))
            c = a[digit]
        out.append(c)
    return "".join(reversed(out))


def _luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def _ip_range(ip: int) -> str:
    if ip >> 24 in (0, 10, 127) or ip >> 20 == 0xAC1 or ip >> 16 in (0xC0A8, 0xA9FE):
        return "private"
    return "reserved" if ip >> 28 >= 0xE else "public"


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """The normal form of the surrogate of an entity in its normal form."""
    tweak = f"{kind}/{attempt}"
    if kind == "ip":
        number = int.from_bytes(bytes(map(int, value.split("."))), "big")
        new = permuted(number, 1 << 32, key, tweak)
        while _ip_range(new) != _ip_range(number):
            new = permuted(new, 1 << 32, key, tweak)
        return ".".join(map(str, new.to_bytes(4, "big")))
    if kind == "card":
        new = _same_format(value, key, tweak)
        while _luhn(new) != _luhn(value):
            new = _same_format(new, key, tweak)
        return new
    if kind == "email":
        name, _, domain = value.rpartition("@")
        host, _, top = domain.rpartition(".")
        return f"{_same_format(name, key, tweak)}@{_same_format(host, key, kind)}.{top}"
    if kind == "iban":
        return value[:2] + _same_format(value[2:], key, tweak)
    if kind == "secret" and set(value) <= set(_HEX):
        return _same_format(value, key, tweak, [_HEX] * len(value))
    if kind == "family" or kind.startswith("given_"):
        script = "cyrillic" if "а" <= value[0] <= "ӿ" else "greek" if "α" <= value[0] <= "ω" else "latin"
        number, parts = _draw(key, tweak, value), []
        for _ in range(_SYLLABLES_IN_NAME + attempt):
            number, at = divmod(number, len(_SYLLABLES[script]))
            parts.append(_SYLLABLES[script][at])
        return "".join(parts) + _ENDINGS[script][kind]
    return _same_format(value, key, tweak)


def _written(kind: str, found: str, new: str) -> str:
    """A surrogate's normal form in the format in which the entity was found."""
    if kind in ("phone", "card", "ssn", "iban"):
        head = found[: len(found) - len(_national(found))] if kind == "phone" else ""
        signs = iter(new)
        return head + "".join(_cased(c, next(signs)) if c.isalnum() else c for c in found[len(head) :])
    if kind == "family" or kind.startswith("given_"):
        return new.upper() if found == found.upper() else new.capitalize()
    if kind == "email" and len(found) == len(new):
        return "".join(map(_cased, found, new))
    if kind == "secret" and found == found.upper() != found.lower():
        return new.upper()
    return new


def _cased(like: str, c: str) -> str:
    return c.upper() if like.isupper() else c


# --- documents -----------------------------------------------------------------------------------

_KEY = ["doc_key", "text_hash"]
_SPANS = "array<struct<start:int,end:int,kind:string,surrogate:string>>"


def _remembered() -> Callable:
    # Made in the task: a cache around the function itself could only be sent to a task by its name.
    return lru_cache(maxsize=REMEMBERED)(surrogate)


def _parsed(told: str | None) -> Genders:
    """Genders told elsewhere, from text such as ``anna weber=f;...``."""
    pairs = (x.rpartition("=") for x in told.split(";")) if told else ()
    return {tuple(name.split(" ")): gender for name, _, gender in pairs}


def _person_finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for number, text in enumerate(batch.column("text")):
            rows += [(number, f"{first} {last}", gender) for first, last, gender in persons(text.as_py() or "")]
        of, names, genders = zip(*rows, strict=True) if rows else ((), (), ())
        own = [batch.column(c).take(pa.array(of, pa.int32())) for c in _KEY]
        yield pa.RecordBatch.from_arrays([*own, pa.array(names, pa.string()), pa.array(genders, pa.string())], [*_KEY, "person", "gender"])


def _finder(key: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = _remembered()
        for batch in batches:
            rows = []
            for number, (text, told) in enumerate(zip(batch.column("text"), batch.column("told"), strict=True)):
                for kind, value in dict.fromkeys(x[2:] for x in entities(text.as_py() or "", _parsed(told.as_py()))):
                    rows.append((number, kind, value, remembered(kind, value, key)))
            of, *columns = zip(*rows, strict=True) if rows else ((), (), (), ())
            own = [batch.column(c).take(pa.array(of, pa.int32())) for c in _KEY]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, pa.string()) for c in columns)], [*_KEY, "kind", "value", "surrogate"])

    return run


def _again(key: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["surrogate"] = surrogate(r["kind"], r["value"], key, r["attempt"])
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    return run


def _rewriter(key: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = _remembered()
        for batch in batches:
            texts, spans = [], []
            for text, told, tries in zip(*(batch.column(c) for c in ("text", "told", "tries")), strict=True):
                text, tries = text.as_py(), tries.as_py()
                attempts = {(t["kind"], t["value"]): t["attempt"] for t in json.loads(tries)} if tries else {}
                out, marks, at, grown = [], [], 0, 0
                for start, end, kind, value in entities(text or "", _parsed(told.as_py())):
                    new = remembered(kind, value, key, attempts.get((kind, value), 0))
                    new = _written(kind, text[start:end], new)
                    out += [text[at:start], new]
                    marks.append({"start": start + grown, "end": start + grown + len(new), "kind": kind, "surrogate": new})
                    at, grown = end, grown + len(new) - (end - start)
                texts.append("".join([*out, text[at:]]) if out else text)
                spans.append(marks)
            # Plain text columns; the spans follow as Spark's own array type.
            span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("surrogate", pa.string())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), pa.array(texts, pa.string()), pa.array(spans, pa.list_(span))], ["rest", "text", "spans"]
            )

    return run


def _collisions(known: DataFrame) -> DataFrame:
    """Entities whose surrogate another, smaller value has too, or that is itself an entity of the documents."""
    least = known.groupBy("kind", "surrogate").agg(F.min("value").alias("least"), F.count(F.lit(1)).alias("n"))
    shared = known.join(least.where("n > 1"), ["kind", "surrogate"]).where("value != least").select("kind", "value")
    real = known.select("kind", F.col("value").alias("surrogate"))
    itself = known.join(real, ["kind", "surrogate"], "left_semi").select("kind", "value")
    return shared.unionByName(itself).distinct()


def retries(mentions: DataFrame, key: bytes) -> DataFrame | None:
    """``kind, value, attempt`` of the entities whose first surrogate collides; None if there is none."""
    known = stage(
        mentions.groupBy("kind", "value").agg(F.min("surrogate").alias("surrogate")).withColumn("attempt", F.lit(0)), "entities"
    )
    for _ in range(MAX_ROUNDS):
        clash = stage(_collisions(known).withColumn("clash", F.lit(1)), "clashes")
        if clash.isEmpty():
            moved = known.where("attempt > 0")
            return None if moved.isEmpty() else moved.select("kind", "value", "attempt")
        marked = known.join(clash, ["kind", "value"], "left")
        raised = marked.withColumn("attempt", F.col("attempt") + F.coalesce("clash", F.lit(0)))
        again = raised.where("clash = 1").drop("clash").mapInArrow(_again(key), known.schema)
        known = stage(raised.where("clash IS NULL").drop("clash").unionByName(again.select(*known.columns)), "entities")
    raise ValueError(f"entities of one format leave no free surrogates after {MAX_ROUNDS} rounds")


def genders_told_elsewhere(keyed: DataFrame) -> DataFrame:
    """Per document that names persons whose gender it does not tell: ``told``, those that other documents tell."""
    schema = "doc_key string, text_hash bigint, person string, gender string"
    named = stage(keyed.select(*_KEY, "text").mapInArrow(_person_finder, schema), "persons")
    told = named.where("gender != ''").groupBy("person").agg(F.min("gender").alias("gender"), F.max("gender").alias("other"))
    agreed = told.where("gender = other").drop("other")
    asked = attach_groups(named.where("gender = ''").drop("gender"), agreed, ["person"], how="inner")
    return asked.groupBy(*_KEY).agg(F.array_join(F.collect_set(F.concat_ws("=", "person", "gender")), ";").alias("told"))


def with_surrogates(docs: DataFrame, key: bytes) -> tuple[DataFrame, str]:
    """The documents with rewritten texts and their other columns, and the name of the added column with
    the spans of the surrogates in the new texts."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    others = [c for c in docs.columns if c != "text"]
    doc_key = F.coalesce(F.concat(F.lit("="), docs["doc_id"].cast("string")), F.lit("")).alias("doc_key")
    rest = F.struct(*[docs[f"`{c}`"] for c in others]).alias("rest")
    keyed = docs.select(rest, docs["text"], doc_key, F.xxhash64(docs["text"]).alias("text_hash"))
    told = attach_groups(keyed, genders_told_elsewhere(keyed), _KEY)
    schema = "doc_key string, text_hash bigint, kind string, value string, surrogate string"
    mentions = stage(told.select(*_KEY, "text", "told").mapInArrow(_finder(key), schema), "mentions")
    moved = retries(mentions, key)
    if moved is None:
        met = told.withColumn("tries", F.lit(None).cast("string"))
    else:
        # The entities of one text, so the list is bounded by it.
        tries = F.to_json(F.collect_set(F.struct("kind", "value", "attempt"))).alias("tries")
        met = attach_groups(told, mentions.join(moved, ["kind", "value"]).groupBy(*_KEY).agg(tries), _KEY)
    met = met.select("rest", "text", "told", "tries")
    rest_type = met.schema["rest"].dataType.simpleString()
    out = met.mapInArrow(_rewriter(key), f"rest {rest_type}, text string, spans {_SPANS}")
    name = "spans"
    while name in docs.columns:
        name = "_" + name
    columns = [F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]
    return out.select(*columns, F.col("spans").alias(name)), name


def rewrite(docs: DataFrame, key: bytes) -> DataFrame:
    """The documents with their own columns and rewritten texts; ``n_chars``, if there, counts the new text."""
    out, spans = with_surrogates(docs, key)
    out = out.drop(spans)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
