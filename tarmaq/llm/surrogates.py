"""Personal data replaced by keyed surrogates that keep type, script, gender and format."""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.llm.common import arrow_map, row_key, stored, table

KEY = b"replace me: the key that makes surrogates repeatable"

_UPPER = "A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ"
_CAPITALISED = rf"[{_UPPER}][\w'’-]*[a-zß-öø-ÿα-ωа-яё]"
#: In capitals nothing but such a word shows where a name ends.
_NO_NAME = ("A|AN|AND|ARE|AS|AT|BUT|BY|FOR|FROM|HAD|HAS|HE|HER|HIS|IN|IS|IT|NOT|OF|ON|OR|SAID|SAYS|"
            "SHE|THAT|THE|THEY|THIS|TO|WAS|WERE|WHO|WILL|WITH")
_SHOUTED = rf"(?!(?:{_NO_NAME})\b)[{_UPPER}](?:['’-]?[{_UPPER}])+(?![\w])"
_NAME_WORD = rf"(?:{_CAPITALISED}|{_SHOUTED})"
_FEMALE = r"Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Κυρία|Госпожа"
_MALE = r"Mr|Herr|Señor|Monsieur|Κύριος|Господин"
_TITLE = rf"(?i:{_FEMALE}|{_MALE}|Dr|Prof)\b\.?"
_SECRET_WORD = "(?i:password|passwd|secret|token|api_?key)"

#: Type and pattern; where patterns meet, the earlier type wins. The group ``e`` is the entity.
PATTERNS: tuple[tuple[str, str], ...] = (
    ("email", r"(?P<e>[A-Za-z0-9][\w.+-]*@[A-Za-z0-9](?:[\w-]*\.)+[A-Za-z]{2,})"),
    ("secret", rf"{_SECRET_WORD}[\"']?\s*[=:]\s*[\"']?"
               r"(?P<e>(?=[/+_-]*[A-Za-z0-9])[A-Za-z0-9/+_-]{8,})"),
    ("access_key", r"\b(?P<e>(?:AKIA|ASIA)[A-Z0-9]{16})\b"),
    ("iban", r"\b(?P<e>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)\b"),
    ("ipv4", r"(?<![\d.])(?P<e>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}"
             r"(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\d.]*\d)"),
    ("card", r"(?<![\w.-])(?P<e>\d(?:[ -]?\d){12,18})(?![\w-])"),
    ("national_id", r"(?<![\w-])(?P<e>\d{3}-\d{2}-\d{4})(?![\w-])"),
    ("phone", r"(?<![\w.+-])(?P<e>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
              r"|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])"),
    ("person", rf"\b{_TITLE}\s+(?P<e>{_NAME_WORD}(?:\s{_NAME_WORD}){{0,2}})"),
)
#: Characters of which every entity above holds one, or a title; other texts are not searched.
_MAYBE = re.compile(rf"[\d@]|AKIA|ASIA|{_SECRET_WORD}|{_TITLE}")
_ALL = [(kind, re.compile(pattern)) for kind, pattern in PATTERNS]

#: Alphabets within which a character is replaced by another of its kind.
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
             "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
             "äöüßéèêëàâáíìîïóòôñúùûçåøæ", "ÄÖÜÉÈÊËÀÂÁÍÌÎÏÓÒÔÑÚÙÛÇÅØÆ")
_HEX, _UPPER_HEX = "0123456789abcdef", "0123456789ABCDEF"
_UPPER_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
#: Syllables of made-up names and their endings by gender, by script.
_NAMES = {
    "latin": (["ka", "lo", "mi", "re", "sa", "ti", "no", "ve", "du", "pa", "ri", "gu"],
              {"female": ["na", "lia", "ra"], "male": ["n", "rd", "s"], "": ["l", "ne", "m"]}),
    "cyrillic": (["ка", "ло", "ми", "ре", "са", "ти", "но", "ве", "ду", "па", "ри", "гу"],
                 {"female": ["на", "лия", "ра"], "male": ["н", "рд", "с"],
                  "": ["л", "не", "м"]}),
    "greek": (["κα", "λο", "μι", "ρε", "σα", "τι", "νο", "βε", "δυ", "πα", "ρι", "γου"],
              {"female": ["να", "λια", "ρα"], "male": ["νος", "ρης", "ς"],
               "": ["λ", "νε", "μ"]}),
}


#: After so many attempts to find a free surrogate of the same length, longer ones are taken.
SAME_LENGTH_ATTEMPTS = 4


@dataclass(frozen=True)
class Entity:
    start: int
    end: int
    kind: str
    #: What makes two mentions the same entity: no layout, no case where case says nothing.
    name: str


def luhn_digit(digits: str) -> str:
    total = 0
    for place, d in enumerate(reversed(digits)):
        value = int(d) * (1 if place % 2 else 2)
        total += value - 9 if value > 9 else value
    return str(-total % 10)


def iban_check(name: str) -> str:
    """The check digits that an account number with its country has to carry."""
    number = int("".join(str(int(c, 36)) for c in name[4:] + name[:2] + "00"))
    return f"{98 - number % 97:02d}"


def _canonical(kind: str, text: str) -> str | None:
    if kind in ("card", "phone", "national_id", "iban", "ipv4"):  # in ASCII digits
        text = "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)
    if kind == "card":
        digits = re.sub(r"\D", "", text)
        return digits if luhn_digit(digits[:-1]) == digits[-1] else None
    if kind in ("phone", "national_id"):
        return ("+" if text.startswith("+") else "") + re.sub(r"\D", "", text)
    if kind == "email":
        return text.lower()
    if kind == "iban":
        return text.replace(" ", "")
    return text


def find(text: str | None) -> list[Entity]:
    """All entities, by place; none overlap."""
    if not text or not _MAYBE.search(text):
        return []
    found: list[Entity] = []
    taken = bytearray(len(text))  # a mark for each character of an entity
    titled: list[tuple[int, int, str]] = []
    for kind, pattern in _ALL:
        for match in pattern.finditer(text):
            start, end = match.span("e")
            if taken.find(1, start, end) >= 0:
                continue
            if kind == "person":
                title = match.group(0)[: start - match.start()].strip(" .\t\n")
                gender = ("female" if re.fullmatch(_FEMALE, title, re.I) else
                          "male" if re.fullmatch(_MALE, title, re.I) else "")
                end -= 2 if re.search("['’][sS]$", match.group("e")) else 0
                titled.append((start, end, gender))
                taken[start:end] = b"\1" * (end - start)
                continue
            name = _canonical(kind, match.group("e"))
            if name is not None:
                found.append(Entity(start, end, kind, name))
                taken[start:end] = b"\1" * (end - start)
    if titled:
        found += _people(text, titled, taken)
    return sorted(found, key=lambda e: e.start)


def _people(text: str, titled: list[tuple[int, int, str]],
            taken: bytearray) -> list[Entity]:
    """The titled names of a text, and where their words stand again without a title.

    A name is a list of words with their parts, ``male:paul surname:gray``, so that mentions agree
    in the words they share. A given name has the gender of any title that its person has here.
    """
    told = [(tuple(text[a:b].lower().split()), gender) for a, b, gender in titled]
    given = {w for words, _ in told for w in words[:-1]}
    last = {words[-1] for words, _ in told if len(words) > 1}
    surnames = last | {words[0] for words, _ in told if len(words) == 1} - given

    whole, alone, any_given = defaultdict(set), defaultdict(set), defaultdict(set)
    for words, gender in set(told):
        if gender:
            if len(words) > 1:
                whole[words[0], words[-1]].add(gender)
            alone[words].add(gender)
            for word in words[:-1] or words:
                any_given[word].add(gender)

    def gender_of(words: tuple[str, ...], surname: bool) -> str:
        ways = ([whole.get((words[0], words[-1])), alone.get(words[-1:])] if surname
                else [any_given.get(words[0])])
        known = next((x for x in ways if x), set())
        return min(known) if len(known) == 1 else "given"

    def name(words: tuple[str, ...], gender: str) -> str:
        surname = words[-1] in surnames
        first = gender or gender_of(words, surname)
        return " ".join([f"{first}:{w}" for w in words[: len(words) - surname]]
                        + [f"surname:{w}" for w in words[len(words) - surname :]])

    out = [Entity(a, b, "person", name(words, gender))
           for (a, b, gender), (words, _) in zip(titled, told, strict=True)]
    forms = {f for a, b, _ in titled for w in text[a:b].split()
             if not re.fullmatch(_NO_NAME, w.upper())
             for f in (w, w.upper(), w.title())}
    if forms:
        word = f"(?:{'|'.join(map(re.escape, sorted(forms, reverse=True)))})(?!\\w|[-’']\\w\\w)"
        for match in re.finditer(rf"(?<![\w'’-]){word}(?:\s{word}){{0,2}}", text):
            a, b = match.span()
            if taken.find(1, a, b) < 0:
                out.append(Entity(a, b, "person", name(tuple(match[0].lower().split()), "")))
    return out


def parts(kind: str, name: str) -> list[str]:
    """What has a surrogate of its own in a name: each word of a person's."""
    return name.split() if kind == "person" else [name]


class Generator:
    """Keyed surrogates of canonical names.

    Characters are permuted within their alphabets by a Feistel network over all names of the same
    shape, so different names of a shape never share a surrogate. ``attempt`` gives further ones.
    """

    def __init__(self, key: bytes):
        self.key = key

    def _number(self, tweak: str, value: int, bits: int) -> int:
        digest = hmac.new(self.key, f"{tweak}|{value}".encode(), hashlib.sha256).digest()
        return int.from_bytes(digest, "big") & ((1 << bits) - 1)

    def _permute(self, value: int, size: int, tweak: str) -> int:
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        while True:  # walks the cycle until it is back inside
            left, right = value >> half, value & mask
            for turn in range(6):
                left, right = right, left ^ self._number(f"{tweak}/{turn}", right, half)
            value = left << half | right
            if value < size:
                return value

    def _spell(self, text: str, alphabets: tuple[str, ...], tweak: str) -> str:
        """Permute all characters of ``text`` that are in an alphabet; the others stay."""
        kinds = [next((a for a in alphabets if c in a), "") for c in text]
        size, value = 1, 0
        for c, a in zip(text, kinds, strict=True):
            if a:
                size, value = size * len(a), value * len(a) + a.index(c)
        if size == 1:
            return text
        shape = "".join(a[0] if a else c for c, a in zip(text, kinds, strict=True))
        value = self._permute(value, size, f"{tweak}|{shape}")
        out = []
        for c, a in zip(reversed(text), reversed(kinds), strict=True):
            if a:
                value, digit = divmod(value, len(a))
                out.append(a[digit])
            else:
                out.append(c)
        return "".join(reversed(out))

    def surrogate(self, kind: str, name: str, attempt: int = 0) -> str:
        """Another canonical name of the same kind and format.

        Later attempts give longer ones: names of one shape still never share one, and as the length
        doubles with each attempt, no earlier surrogate and no real name stays in the way. Addresses
        keep their four numbers, of which there are 2^32.
        """
        tweak = f"{kind}/{attempt}"
        longer = (0 if attempt < SAME_LENGTH_ATTEMPTS
                  else 1 << (attempt - SAME_LENGTH_ATTEMPTS))
        if kind == "ipv4":
            octets = [int(x) for x in name.split(".")]
            number = self._permute(int.from_bytes(bytes(octets), "big"), 1 << 32, tweak)
            return ".".join(map(str, number.to_bytes(4, "big")))  # there is no longer address
        if kind == "card":
            body = name[0] + self._spell(name[1:-1] + "0" * longer, ALPHABETS[:1], tweak)
            return body + luhn_digit(body)
        if kind == "phone" and name.startswith("+"):
            country = name[: max(2, len(name) - 10)]
            return country + self._spell(name[len(country):] + "0" * longer, ALPHABETS[:1], tweak)
        if kind == "access_key":
            return name[:4] + self._spell(name[4:] + "A" * longer, (_UPPER_DIGITS,), tweak)
        if kind == "secret" and re.fullmatch("[0-9a-f]+", name):
            return self._spell(name + "0" * longer, (_HEX,), tweak)
        if kind == "secret" and re.fullmatch("[0-9A-F]+", name):
            return self._spell(name + "0" * longer, (_UPPER_HEX,), tweak)
        if kind == "iban":
            if name[2:4] == iban_check(name):  # equal accounts have equal check digits
                other = name[:2] + "00" + self._spell(name[4:] + "0" * longer, ALPHABETS[:3], tweak)
                return other[:2] + iban_check(other) + other[4:]
            return name[:2] + self._spell(name[2:] + "0" * longer, ALPHABETS[:3], tweak)
        if kind == "email":
            local, _, domain = name.partition("@")
            hosts, dot, top = domain.rpartition(".")
            local += "a" * longer
            return f"{self._spell(local + '@' + hosts, ALPHABETS, tweak)}{dot}{top}"
        if kind == "person":
            return " ".join(
                f"{part}:{self._given(w, part, f'{tweak}/{part}:{w}', longer)}"
                for part, _, w in (x.partition(":") for x in name.split()))
        return self._spell(name + "0" * longer, ALPHABETS, tweak)

    def _given(self, word: str, gender: str, tweak: str, longer: int = 0) -> str:
        script = ("cyrillic" if re.search("[а-яё]", word.lower()) else
                  "greek" if re.search("[α-ω]", word.lower()) else "latin")
        syllables, endings = _NAMES[script]
        number = self._number(tweak, 0, 256)
        out = []
        for _ in range(max(2, min(6, len(word) // 2)) + longer):
            number, pick = divmod(number, len(syllables))
            out.append(syllables[pick])
        kind = endings.get(gender, endings[""])
        return "".join(out) + kind[number % len(kind)]


def _digit_like(said: str, digit: str) -> str:
    """``digit`` in the script of the digit ``said``."""
    if said.isascii() or not said.isdecimal():
        return digit
    return chr(ord(said) - unicodedata.decimal(said) + int(digit))


def render(kind: str, mention: str, surrogate: str) -> str:
    """The surrogate in the layout of one mention."""
    if kind == "person":
        words = [w.upper() if m.isupper() else w.capitalize() for m, w in zip(
            mention.split(), (x.partition(":")[2] for x in surrogate.split()), strict=True)]
        gaps = re.findall(r"\s+", mention)
        return words[0] + "".join(g + w for g, w in zip(gaps, words[1:], strict=False))
    if kind == "email" and mention != mention.lower():
        if mention == mention.upper():
            return surrogate.upper()
        return "@".join("".join(s.upper() if m.isupper() else s for m, s in zip_longest(
            said, part, fillvalue="")) for said, part in zip(
                mention.split("@"), surrogate.split("@"), strict=True))
    symbols: Iterator[str] = iter(c for c in surrogate if c.isalnum())
    if kind in ("card", "phone", "national_id", "iban"):
        told = "".join(_digit_like(c, next(symbols)) if c.isalnum() else c for c in mention)
        return told + "".join(symbols)
    return surrogate


@cache
def _generator(key: bytes) -> Generator:
    return Generator(key)


def entities(texts: DataFrame) -> DataFrame:
    """``key, kind, name`` for each entity of each ``key, text``, once per text; of a person's name
    for each word."""

    def rows(batch: pa.RecordBatch):
        out: dict[str, list] = {"key": [], "kind": [], "name": []}
        for key, text in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), strict=True):
            for kind, name in sorted({(e.kind, n) for e in find(text) for n in parts(e.kind, e.name)}):
                out["key"].append(key)
                out["kind"].append(kind)
                out["name"].append(name)
        yield out

    return arrow_map(texts, rows, "key bigint, kind string, name string")


def assign(names: DataFrame, key: bytes = KEY,
           generate: Callable[[str, str, int], str] | None = None) -> DataFrame:
    """``kind, name, attempt, surrogate`` for distinct ``kind, name``, without collisions.

    A surrogate must differ from every other surrogate and from every name that occurs in the
    corpus, else two people would merge. All entities in conflict but the first try again, after
    ``SAME_LENGTH_ATTEMPTS`` with longer surrogates: so names settle even where there are more of
    them than names of their shape. Words of a person's name are compared without their part, before
    the colon. Each round is a table in the shared folder, and only rows in
    conflict are generated again.
    """
    generate = generate or _generator(key).surrogate

    def rows(batch: pa.RecordBatch):
        columns = {c: batch[c] for c in ("kind", "name", "attempt")}
        yield columns | {"surrogate": [generate(*x) for x in zip(
            *(columns[c].to_pylist() for c in ("kind", "name", "attempt")), strict=True)]}

    schema = "kind string, name string, attempt int, surrogate string"
    names = stored(names.select("kind", "name").distinct(), "names")
    current = stored(arrow_map(names.withColumn("attempt", F.lit(0)), rows, schema), "surrogates")
    while True:
        bare = current.withColumn("bare", F.substring_index("surrogate", ":", -1))
        firsts = bare.groupBy("kind", "bare").agg(
            F.count("*").alias("sharing"), F.min(F.struct("attempt", "name")).alias("first"))
        shared = bare.join(firsts.where("sharing > 1"), ["kind", "bare"]).where(
            F.struct("attempt", "name") != F.col("first")).select("kind", "name")
        real = bare.join(names.select("kind", F.substring_index("name", ":", -1).alias("bare")),
                         ["kind", "bare"], "left_semi").select("kind", "name")
        conflicts = stored(shared.union(real).distinct(), "conflicts")
        if conflicts.isEmpty():
            return current
        again = current.join(conflicts, ["kind", "name"], "left_semi").select(
            "kind", "name", (F.col("attempt") + 1).alias("attempt"))
        current = stored(current.join(conflicts, ["kind", "name"], "left_anti").unionByName(
            arrow_map(again, rows, schema)), "surrogates")


def pseudonymised(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  key: bytes = KEY, count_column: str | None = "n_entities") -> DataFrame:
    """``documents`` with every entity in the text replaced, and their number added.

    The same entity gets the same surrogate in all documents, different ones never share one. Each
    document receives just the surrogates it needs by a join, so nothing grows on the driver. Null
    texts stay null with 0 entities, texts without entities stay as they are, rows may repeat, and
    a column that is called like ``count_column`` is replaced.
    """
    others = [c for c in documents.columns if c not in (text_column, count_column)]
    rows_in = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("document"),
        F.col(f"`{text_column}`").alias("text"),
        row_key(*dict.fromkeys([id_column, text_column])).alias("key"))
    found = stored(entities(rows_in.select("key", "text")).distinct(), "entities")
    assigned = assign(found, key)
    needed = found.join(assigned, ["kind", "name"]).groupBy("key").agg(F.collect_list(
        F.struct("kind", "name", "surrogate")).alias("needed"))

    def rows(batch: pa.RecordBatch):
        texts, counts = [], []
        for text, wanted in zip(batch["text"].to_pylist(), batch["needed"].to_pylist(),
                                strict=True):
            if not wanted:
                texts.append(text)
                counts.append(0)
                continue
            known = {(w["kind"], w["name"]): w["surrogate"] for w in wanted}
            out, at, count = [], 0, 0
            for e in find(text):
                out += [text[at : e.start],
                          render(e.kind, text[e.start : e.end], " ".join(
                              known[e.kind, n] for n in parts(e.kind, e.name)))]
                at, count = e.end, count + 1
            texts.append("".join([*out, text[at:]]))
            counts.append(count)
        yield {"document": batch["document"], "text": texts, "n_entities": counts}

    kind = rows_in.schema["document"].dataType.simpleString()
    replaced = arrow_map(rows_in.join(needed, "key", "left"), rows,
                         f"document {kind}, text string, n_entities bigint")
    return replaced.select(*[
        F.col("text").alias(text_column) if c == text_column else F.col(f"document.`{c}`")
        for c in documents.columns if c != count_column],
        *[F.col("n_entities").alias(count_column)] if count_column else [])


def op10_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonymised(documents)
