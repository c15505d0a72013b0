"""Personal data replaced by keyed surrogates of the same type, format, script and gender."""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reachmart.llm.common import numbered, renamed

KINDS = ["email", "phone", "ip", "ssn", "card", "iban", "secret", "name"]

# Given names by gender and script: what is looked for, and what replaces them.
GIVEN = {
    ("female", "latin"): (
        "Anna Maria Emma Sophie Laura Julia Marie Clara Lucia Elena Sarah Emily Alice Camille Chloe Ines "
        "Carmen Paula Katharina Johanna Margaret Linda Susan Helen Isabel Nadia Olivia Charlotte Amelia Greta"
    ).split(),
    ("male", "latin"): (
        "John Peter Paul Thomas Michael David Daniel Martin Lukas Felix Jonas Karl Hans Pierre Louis Antoine "
        "Carlos Miguel Javier Diego Robert James William George Henry Stefan Andreas Philipp Oliver Hugo"
    ).split(),
    ("female", "cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана".split(),
    ("male", "cyrillic"): "Иван Пётр Сергей Дмитрий Алексей Николай Андрей Михаил".split(),
    ("female", "greek"): "Μαρία Ελένη Κατερίνα Σοφία Αγγελική".split(),
    ("male", "greek"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης".split(),
}
# Forms of address; the name after one of them is taken for a family name.
TITLES = ["Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora"]

_FAMILY = r"(?:(?:von|van|de|del|di|da|la)\s)?[^\W\d_a-zа-яα-ω][^\W\d_]+(?:-[^\W\d_]+)?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_DIGITS = re.compile(
    r"(?P<secret>\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9]{20,}\b"
    r"|\b(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{32,}\b)"
    r"|(?P<email>[^\W_][\w.%+\-]*@[^\W_][\w\-]*(?:\.[^\W_][\w\-]*)+)"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<phone>(?<![\w+])(?:\+?\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3}[ .\-]?\d{3,4}(?!\w)"
    r"|(?<![\w+.\-])\d{3}([.\- ])\d{3}\5\d{4}(?![\w\-])"
    r"|(?<![\w+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\w)"
    r"|(?<![\w+.\-])0\d(?:[ .\-]\d{2}){4}(?![\w\-])|(?<![\w+.\-])0\d{1,4}[ /\-]\d{5,8}(?![\w\-])"
    r"|(?<![\w+.\-])\d{10}(?![\w\-]))"
    rf"|(?P<ip>(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)"
    r"|(?<![\w:.])(?=[a-fA-F:]*\d)(?=[0-9a-fA-F]*:[0-9a-fA-F]*:)[0-9a-fA-F:]{3,39}(?![\w:]))"
    r"|(?P<ssn>(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-]))"
    r"|(?P<card>(?<!\w)(?:\d{13,19}|\d{4}([ \-])\d{4}\9\d{4}\9\d{1,7}|\d{4}([ \-])\d{6}\10\d{5})(?!\w))"
)
_HINT = re.compile(r"[0-9@]")
_LETTERS = re.compile(r"[^\W\d_]+")
_WORDS = re.compile(rf"\b(?:{_FAMILY}|[^\W\d_]+)\b")
_GIVEN_OF = {name: key for key, names in GIVEN.items() for name in names}
_MARKERS = frozenset(_GIVEN_OF) | frozenset(TITLES)
_NAMES = re.compile(
    rf"\b(?P<title>{'|'.join(TITLES)})\b\.?\s(?:(?P<first>{'|'.join(_GIVEN_OF)})\s)?(?P<family>{_FAMILY})"
    rf"|\b(?P<given>{'|'.join(_GIVEN_OF)})\s(?P<last>{_FAMILY})"
)


# --- keyed permutations -------------------------------------------------------------------


class Permutation:
    """A keyed one-to-one map of the numbers below ``size`` without fixed points.

    A Feistel network E shuffles the numbers; the map takes x to the number whose E is one
    shift after E(x). It is one-to-one because each part is, and has no fixed point because
    the shift has none.
    """

    ROUNDS = 8

    def __init__(self, key: bytes, name: str, size: int):
        self.key = hashlib.blake2b(name.encode(), key=key, digest_size=32).digest()
        self.size = size
        self.left = math.isqrt(max(size - 1, 0)) + 1
        self.right = -(-size // self.left)
        self.shift = self._hash(b"shift", 0) % (size - 1) + 1 if size > 1 else 0

    def _hash(self, label: bytes, value: int) -> int:
        data = label + value.to_bytes((value.bit_length() + 7) // 8 + 1, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "big")

    def _once(self, x: int, forward: bool) -> int:
        a, b = x % self.left, x // self.left
        for i in range(self.ROUNDS) if forward else reversed(range(self.ROUNDS)):
            sign = 1 if forward else -1
            if i % 2:
                b = (b + sign * self._hash(b"%d" % i, a)) % self.right
            else:
                a = (a + sign * self._hash(b"%d" % i, b)) % self.left
        return b * self.left + a

    def _walk(self, x: int, forward: bool) -> int:
        x = self._once(x, forward)
        while x >= self.size:
            x = self._once(x, forward)
        return x

    def __call__(self, x: int, accept: Callable[[int], bool] = lambda y: True) -> int:
        """Where ``accept`` holds for x, the result is the next number for which it holds,
        so the numbers that are accepted are mapped one-to-one onto themselves."""
        y = x
        for _ in range(1_000):
            y = self._walk((self._walk(y, True) + self.shift) % self.size, False)
            if accept(y):
                return y
        return y


_CLASSES = [
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "аеиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
]
_CLASS_OF = {letter: members for members in _CLASSES for letter in members}


class Surrogates:
    """Surrogates of the entities of one key. ``attempts`` picks other maps, by kind."""

    def __init__(self, key: bytes, attempts: dict[str, int] | None = None):
        self.key, self.attempts = key, attempts or {}
        self._map = lru_cache(4_096)(self._new)

    def _new(self, kind: str, form: str, size: int) -> Permutation:
        return Permutation(self.key, f"{kind}:{self.attempts.get(kind, 0)}:{form}", size)

    def _digits(self, kind: str, digits: str, accept: Callable[[str], bool] = lambda d: True) -> str:
        n = len(digits)
        number = self._map(kind, str(n), 10**n)(int(digits), lambda y: accept(str(y).zfill(n)))
        return str(number).zfill(n)

    def _letters(self, kind: str, text: str) -> str:
        """Keeps the kind of each character: digit, vowel or consonant of a script; others stay.

        Accents are taken off first, so that one name has one surrogate however it is typed.
        """
        form = [_CLASS_OF.get(c) for c in text]
        sizes = [len(members) for members in form if members]
        if not sizes:
            return text
        number, size = 0, 1
        for c, members in zip(text, form):
            if members:
                number, size = number * len(members) + members.index(c), size * len(members)
        pattern = "".join(c if members is None else str(_CLASSES.index(members)) + "_" for c, members in zip(text, form))
        number = self._map(kind, pattern, size)(number)
        out = []
        for c, members in zip(reversed(text), reversed(form)):
            if members:
                number, place = divmod(number, len(members))
                c = members[place]
            out.append(c)
        return "".join(reversed(out))

    def of(self, kind: str, value: str) -> str:
        """Surrogate of a canonical value."""
        if kind == "email":
            local, _, domain = value.partition("@")
            # The top-level domain stays; all before it belongs to the entity.
            host, _, top = domain.rpartition(".")
            return self._letters("email", f"{local}@{host}") + "." + top
        if kind == "phone":
            lead = value[:-10] if len(value) > 10 else ""
            return lead + self._digits("phone", value[len(lead) :])
        if kind == "ip":
            if ":" in value:
                return str(ipaddress.IPv6Address(self._map("ip", "6", 2**128)(int(ipaddress.IPv6Address(value)))))
            number = 0
            for part in value.split("."):
                number = number * 256 + int(part)
            number = self._map("ip", "4", 256**4)(number)
            return ".".join(str(number >> shift & 255) for shift in (24, 16, 8, 0))
        if kind == "card":
            valid = luhn(value)
            return self._digits("card", value, lambda d: luhn(d) == valid)
        if kind in ("ssn", "iban", "secret"):
            return value[:2] + self._mixed(kind, value[2:]) if kind == "iban" else self._mixed(kind, value)
        gender, _, rest = value.partition(":")
        if gender == "family":
            return "family:" + self._letters("name", rest)
        names = GIVEN[_GIVEN_OF[rest]]
        order = self._map("name", gender, len(names))
        return f"{gender}:{names[order(names.index(rest))]}"

    def _mixed(self, kind: str, text: str) -> str:
        """Digits and letters of codes. Codes of digits, hexadecimal codes, codes of one case
        and of both are mapped among themselves; a known prefix stays."""
        prefix = _PREFIX.match(text) if kind == "secret" else None
        lead = prefix[0] if prefix else ""
        text = text[len(lead) :]
        group = _group(text)
        alphabet = _ALPHABETS[group[0]]
        places = [c for c in text if c in alphabet]
        if not places:
            return lead + text
        number = 0
        for c in places:
            number = number * len(alphabet) + alphabet.index(c)
        form = lead + "".join("x" if c in alphabet else c for c in text) + ":" + "-".join(map(str, group))

        def written(y: int) -> str:
            made = []
            for _ in places:
                y, place = divmod(y, len(alphabet))
                made.append(alphabet[place])
            return "".join(reversed(made))

        mapped = self._map(kind, form, len(alphabet) ** len(places))(number, lambda y: _group(written(y)) == group)
        digits = iter(written(mapped))
        return lead + "".join(next(digits) if c in alphabet else c for c in text)


_PREFIX = re.compile(r"AKIA|ASIA|gh[pousr]_|sk-")
_ALPHABETS = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "lower": "0123456789abcdefghijklmnopqrstuvwxyz",
    "upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "both": "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
}


def _group(code: str) -> tuple[str, bool]:
    """The least alphabet of a code, and whether it has a digit."""
    letters = [c for c in code if c.isalpha()]
    some = any(c.isdigit() for c in code)
    if not letters:
        return "digits", some
    if all(c in "abcdef" for c in letters):
        return "hex", some
    low, high = any(c.islower() for c in letters), any(c.isupper() for c in letters)
    return ("both" if low and high else "lower" if low else "upper"), some


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


# --- detection and layout -----------------------------------------------------------------


def canonical(kind: str, text: str) -> str:
    """One form for all spellings of an entity, so that they keep one surrogate."""
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "ip":
        return str(ipaddress.IPv6Address(text)) if ":" in text else text
    if kind == "secret":
        # Hexadecimal codes mean the same in capitals; other codes do not.
        return text.lower() if re.fullmatch("[0-9a-fA-F]+", text) else text
    return text.lower()


def bare(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))


def laid_out(kind: str, text: str, surrogate: str) -> str:
    """The surrogate in the format of the text it replaces: separators and capitals."""
    if kind == "ip":
        return surrogate
    if kind == "secret":
        return surrogate.upper() if text.isupper() else surrogate
    letters = iter(surrogate.replace(" ", ""))
    keep = {"email": "", "phone": " .-()+", "card": " -", "ssn": " -", "iban": " "}.get(kind, "")
    out = []
    for c in text:
        if c in keep or kind in ("phone", "card", "ssn") and not c.isdigit():
            out.append(c)
        else:
            made = next(letters, "")
            out.append(made.upper() if c.isupper() else made)
    return "".join(out) + "".join(letters)


def _is_ipv6(text: str) -> bool:
    try:
        return bool(ipaddress.IPv6Address(text))
    except ValueError:
        return False


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and canonical value of the entities of a text, in order."""
    found = []
    if _HINT.search(text):
        for match in _DIGITS.finditer(text):
            kind = match.lastgroup
            if kind == "ip" and ":" in match[kind] and not _is_ipv6(match[kind]):
                continue
            found.append((match.start(kind), match.end(kind), kind, canonical(kind, match[kind])))
    if not _MARKERS.isdisjoint(_LETTERS.findall(text)):
        for match in _NAMES.finditer(text):
            for part, value in match.groupdict().items():
                if value is None or part == "title":
                    continue
                start, end = match.span(part)
                if part in ("first", "given"):
                    found.append((start, end, "name", f"{_GIVEN_OF[value][0]}-{_GIVEN_OF[value][1]}:{value}"))
                else:
                    found.append((start, end, "name", f"family:{bare(value)}"))
        # Names seen once in full are the same person's where they stand alone.
        known = {value for _, _, kind, value in found if kind == "name"}
        whole = list(found)
        for match in _WORDS.finditer(text) if known else ():
            last = match[0].split()[-1]
            given = _GIVEN_OF.get(last.capitalize())
            for own, value in (
                (match[0], f"family:{bare(match[0])}"),
                (last, f"{given[0]}-{given[1]}:{last.capitalize()}" if given else ""),
                (last, f"family:{bare(last)}"),
            ):
                if value in known and last[0].isupper():
                    start = match.end() - len(own)
                    # Part of an address or of a full name: replaced with that.
                    if not any(start < e and match.end() > b for b, e, _, _ in whole):
                        found.append((start, match.end(), "name", value))
                    break
        found.sort()
    kept, end = [], 0
    for one in found:
        if one[0] >= end:
            kept.append(one)
            end = one[1]
    return kept


def replaced(text: str, maps: Surrogates) -> tuple[str, dict[str, int]]:
    """The text with surrogates, and the number of replacements by kind."""
    counts = dict.fromkeys(KINDS, 0)
    out, at = [], 0
    for start, end, kind, value in entities(text):
        own = text[start:end]
        made = maps.of(kind, value)
        if kind == "name":
            made = made.partition(":")[2]
            made = made if not value.startswith("family:") else laid_out("family", own, made)
        else:
            made = laid_out(kind, own, made)
        out += [text[at:start], made]
        at = end
        counts[kind] += 1
    return ("".join([*out, text[at:]]) if at else text), counts


# --- the operator -------------------------------------------------------------------------


def collisions(docs: DataFrame, key: bytes, attempts: dict[str, int], text: str = "text") -> dict[str, int]:
    """By kind, how many surrogates stand for more than one entity of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = Surrogates(key, attempts)
        for batch in batches:
            seen = set()
            for value in batch.column(0).to_pylist():
                seen.update((kind, value) for _, _, kind, value in entities(value))
            rows = sorted(seen)
            columns = [[k for k, _ in rows], [v for _, v in rows], [maps.of(k, v) for k, v in rows]]
            arrays = [pa.array(column, pa.string()) for column in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["kind", "value", "surrogate"])

    pairs = docs.filter(F.col(text).isNotNull()).select(text).mapInArrow(run, "kind string, value string, surrogate string")
    groups = pairs.groupBy("kind", "surrogate").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    shared = groups.filter("a <> b").groupBy("kind").count()
    return {row["kind"]: row["count"] for row in shared.collect()}


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", tries: int = 4) -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``n_email`` and so on, one count per kind.

    An entity has the same surrogate wherever it occurs, in any spelling, and two entities
    never share one: digits and letters go through keyed one-to-one maps of their format,
    and given names through one of their gender and script. Before the texts are rewritten,
    all distinct entities are checked for shared surrogates; a kind that has some takes
    other maps and is checked again, and the job fails if that does not help.

    * A family or given name found with a title or a listed given name is also replaced where
      it stands alone in the same document. Other persons are not detected.
    * A null text stays null, and texts without an entity stay as they are.
    * A surrogate can equal some other real value by chance; that value is replaced, too.
    * Repeated rows are replaced alike. An empty table stays empty. Columns named like a
      count are replaced; others pass through.
    """
    attempts: dict[str, int] = {}
    for _ in range(tries):
        clashing = collisions(docs, key, attempts, text)
        if not clashing:
            break
        for kind in clashing:
            attempts[kind] = attempts.get(kind, 0) + 1
    else:
        raise ValueError(f"surrogates are shared: {clashing}")
    counts = [f"n_{kind}" for kind in KINDS]
    rows, place = numbered(docs, tuple(counts))
    others = [number for name, number in place.items() if name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = Surrogates(key, attempts)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            made = [(None, dict.fromkeys(KINDS, 0)) if t is None else replaced(t, maps) for t in texts]
            arrays = [*batch.columns[:-1], pa.array([t for t, _ in made], pa.string())]
            arrays += [pa.array([n[kind] for _, n in made], pa.int32()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(arrays, names=[*others, "_text", *counts])

    carried = rows.select(*others, F.col(place[text]).alias("_text"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in carried.schema]
    made = carried.mapInArrow(run, ", ".join([*fields, *[f"{c} int" for c in counts]]))
    return renamed(made, place | {text: "_text"}, *counts)
