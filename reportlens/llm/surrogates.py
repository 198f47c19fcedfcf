"""Personal data replaced by keyed surrogates of the same type and format.

Every surrogate is the image of its original under a keyed permutation of all strings of the
same shape: letters become letters of the same script and case, digits digits, other characters
stay. Equal originals thus get equal surrogates in all documents (coreference), different ones
different surrogates (distinctness), without any table of entities. The permutation is one long
cycle, so nothing maps to itself. Types keep what makes them valid: check digits of card and
account numbers, the network of private addresses, the top-level domain of mail addresses, the
gender of known first names, whatever the title.

``collisions`` checks distinctness over all entities of a corpus; ``redrawn`` draws again for
those that share a surrogate.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt, prod

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal, land

KEY = b"reportlens surrogates"
ROUNDS = 6

# Titles and common first names by gender.
TITLES = {
    "Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f",
}
FIRST_NAMES = {
    "m": ("James", "John", "Robert", "Michael", "David", "William", "Thomas", "Daniel", "Paul", "Mark",
          "Hans", "Peter", "Karl", "Stefan", "Pierre", "Louis", "Carlos", "Juan", "Pedro"),
    "f": ("Mary", "Linda", "Susan", "Sarah", "Karen", "Emma", "Anna", "Laura", "Julia", "Alice",
          "Greta", "Monika", "Sabine", "Marie", "Claire", "Sophie", "Camille", "Carmen", "Lucia", "Elena"),
    # Names of men and women.
    "u": ("Jean", "Robin", "Kim", "Alex", "Dominique", "Sam", "Andrea", "Claude"),
}
POOL_OF = {name: gender for gender, names in FIRST_NAMES.items() for name in names}
#: Country codes of one and two digits; all others have three.
SHORT_CODES = {"0", "1", "7"} | set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66"
    " 81 82 84 86 90 91 92 93 94 95 98".split()
)
#: Times that a surrogate is drawn at most.
DRAWS = 64
RESERVED = ("example.com", "example.net", "example.org", "example", "test", "invalid", "localhost")

#: Letters that replace each other; all other letters go by blocks of code points.
ALPHABETS = (
    string.digits, string.ascii_lowercase, string.ascii_uppercase,
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþßÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
    "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "אבגדהוזחטיכלמנסעפצקרשת", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
)
HEX = ("0123456789abcdef", "0123456789ABCDEF")
ALPHABET_OF = {c: a for a in ALPHABETS for c in a}


def cycle(value: int, size: int, tweak: bytes, ok: Callable[[int], bool] = lambda _: True) -> int:
    """The next number below ``size`` that is ``ok`` on a keyed cycle through all of them.

    The cycle is x -> P'(P(x) + 1), with P a Feistel permutation and P' its inverse.
    """
    a = isqrt(size - 1) + 1
    b = -(-size // a)

    def draw(k: int, x: int, limit: int) -> int:
        data = tweak + bytes([k]) + x.to_bytes((x.bit_length() + 7) // 8, "big")
        return int.from_bytes(hashlib.blake2b(data, digest_size=32, key=KEY[:64]).digest() * (limit.bit_length() // 192 + 1), "big") % limit

    def turn(x: int, back: bool) -> int:
        left, right = divmod(x, b)
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if k % 2:
                right = (right + sign * draw(k, left, b)) % b
            else:
                left = (left + sign * draw(k, right, a)) % a
        return left * b + right

    x = value
    while True:
        x = turn((turn(x, False) + 1) % (a * b), True)
        if x < size and (x == value or ok(x)):
            return x


def permuted(text: str, tweak: str, alphabets: list[str | None], ok: Callable[[str], bool] | None = None) -> str:
    """``text`` with the characters that have an alphabet permuted within their joint domain."""
    at = [i for i, a in enumerate(alphabets) if a and len(a) > 1]
    if not at:
        return text
    kinds = [alphabets[i] for i in at]
    shape = "".join(c if not a else str(ALPHABETS.index(a)) if a in ALPHABETS else a[-1] for c, a in zip(text, alphabets))

    def spelled(x: int) -> str:
        out = list(text)
        for i, a in zip(reversed(at), reversed(kinds)):
            x, d = divmod(x, len(a))
            out[i] = a[d]
        return "".join(out)

    value = 0
    for i, a in zip(at, kinds):
        value = value * len(a) + a.index(text[i])
    seed = hashlib.sha256(f"{tweak}\0{shape}".encode()).digest()
    good = (lambda x: ok(spelled(x))) if ok else (lambda _: True)
    return spelled(cycle(value, prod(map(len, kinds)), seed, good))


def alphabet(c: str) -> str | None:
    """What may replace ``c``: its script and case, or its block of 256 letters."""
    if c in ALPHABET_OF:
        return ALPHABET_OF[c]
    if not c.isalpha():
        return None
    block = ord(c) // 256 * 256
    case = (c.islower(), c.isupper())
    return block_letters(block, case)


@lru_cache(maxsize=4096)
def block_letters(block: int, case: tuple[bool, bool]) -> str:
    letters = (chr(x) for x in range(block, block + 256))
    return "".join(c for c in letters if c.isalpha() and c not in ALPHABET_OF and (c.islower(), c.isupper()) == case)


def by_shape(text: str, tweak: str, ok: Callable[[str], bool] | None = None) -> str:
    return permuted(text, tweak, [alphabet(c) for c in text], ok)


def with_digits(text: str, digits: str) -> str:
    """``text`` with its digits replaced one by one."""
    new = iter(digits)
    return "".join(next(new) if c in string.digits else c for c in text)


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in string.digits)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def card(text: str) -> str:
    """First digit kept, check digit valid."""
    digits = digits_of(text)
    body = digits[0] + by_shape(digits[1:-1], f"card{digits[0]}{len(digits)}")
    return with_digits(text, next(body + d for d in string.digits if luhn(body + d)))


def phone(text: str) -> str:
    """The country code stays; equal numbers in other formats get equal digits."""
    digits = digits_of(text)
    kept = next((digits[:n] for n in (1, 2) if digits[:n] in SHORT_CODES), digits[:3]) if text.startswith("+") else ""
    return with_digits(text, kept + by_shape(digits[len(kept) :], f"phone{kept}"))


def ssn(text: str) -> str:
    valid = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
    return with_digits(text, by_shape(digits_of(text), "ssn", valid))


def address(text: str) -> str:
    """IPv4: private networks keep their prefix, public addresses stay public."""
    octets = list(map(int, text.split(".")))
    fixed = 1 if octets[0] == 10 else 2 if octets[:2] == [192, 168] else 0

    def ok(x: int) -> bool:
        o = [x >> s & 255 for s in range(8 * (3 - fixed), -1, -8)]
        return fixed > 0 or (1 <= o[0] < 224 and o[0] not in (10, 127) and o[:2] != [192, 168])

    free = 0
    for o in octets[fixed:]:
        free = free << 8 | o
    free = cycle(free, 256 ** (4 - fixed), f"ip{octets[:fixed]}".encode(), ok)
    return ".".join(map(str, [*octets[:fixed], *(free >> s & 255 for s in range(8 * (3 - fixed), -1, -8))]))


def mail(text: str) -> str:
    """Local part and host names by shape; case doesn't tell addresses apart."""
    low = text.lower()
    local, _, host = low.rpartition("@")
    tail = next((x for x in RESERVED if host == x or host.endswith(f".{x}")), "")
    names = host[: len(host) - len(tail)] if tail else host.rpartition(".")[0]
    top = tail or host.rpartition(".")[2]
    new = by_shape(f"{local}@{names}", f"mail{top}") + (tail or f".{top}.example")
    if len(new) == len(text):
        new = "".join(n.upper() if c.isupper() and len(n.upper()) == 1 else n for n, c in zip(new, text))
    return new


def account(text: str) -> str:
    """IBAN: country kept, check digits valid."""
    plain = text.replace(" ", "")
    body = by_shape(plain[4:], f"iban{plain[:2]}")
    number = "".join(str(int(c, 36)) for c in f"{body}{plain[:2]}00")
    new = iter(f"{plain[:2]}{98 - int(number) % 97:02}{body}")
    return "".join(c if c == " " else next(new) for c in text)


def secret(text: str) -> str:
    for a in HEX:
        if all(c in a for c in text):
            return permuted(text, "secret", [a] * len(text))
    return by_shape(text, "secret")


def person(names: str) -> str:
    """Known first names become first names of the same pool, wherever they stand; other names
    change by shape. Each name has one surrogate and each surrogate one name."""
    out = []
    for name in names.split(" "):
        if name in POOL_OF:
            pool = FIRST_NAMES[POOL_OF[name]]
            out.append(pool[cycle(pool.index(name), len(pool), f"first{POOL_OF[name]}".encode())])
        else:
            out.append(by_shape(name, "name", lambda x: x not in POOL_OF))
    return " ".join(out)


SURROGATES = {
    "mail": mail, "phone": phone, "ip": address, "iban": account, "ssn": ssn, "card": card,
    "secret": secret, "person": person,
}


def plain(kind: str, value: str) -> str:
    """The value without the case of mail and the format of numbers."""
    return value.lower() if kind == "mail" else value if kind in ("secret", "person", "ip") else re.sub(r"[^0-9A-Za-z+]", "", value)


NUMBERS = re.compile(
    r"(?P<phone>(?<![\w.])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){1,4}(?!\w)"
    r"|(?<![\w.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-]))"
    r"|(?P<ip>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9]))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<card>(?<![\w])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\6[0-9]{4}\6[0-9]{1,7})(?!\w))"
)
MANY_DIGITS = re.compile(r"[0-9][0-9 ().-]{5}|[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}")
LOCAL = re.compile(r"[\w.+%-]+\Z")
HOST = re.compile(r"[\w-]+(?:\.[\w-]+)+")
SECRET = re.compile(
    r"(?i)(?<![a-z])(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)\"?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9+/_-]{12,})"
)
PERSON = re.compile(
    rf"(?<!\w)({'|'.join(sorted(TITLES, key=len, reverse=True))})\.? ((?!\d)[^\W_a-z][\w'-]+(?: (?!\d)[^\W_a-z][\w'-]+)?)"
)
TITLE_STARTS = tuple(f"{t}{end}" for t in TITLES for end in (" ", ". "))


def entities(text: str, draws: dict[tuple[str, str], int] | None = None) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, surrogate) of what is found, in order and without overlaps.

    ``draws`` has the kinds and plain values whose surrogate is drawn more often than once: the
    surrogate's surrogate, and so on, which has the same type and format.
    """
    found: list[tuple[int, int, str]] = []
    at = text.find("@")
    while at >= 0:
        local, host = LOCAL.search(text[max(0, at - 128) : at]), HOST.match(text, at + 1)
        if local and host and (value := local[0].lstrip(".")):
            begin = at - len(value)
            found.append((begin, host.end(), "mail"))
        at = text.find("@", at + 1)
    if "=" in text or ":" in text:
        found += [(*m.span(1), "secret") for m in SECRET.finditer(text)]
    if MANY_DIGITS.search(text):
        for m in NUMBERS.finditer(text):
            kind, value = m.lastgroup, m[0]
            if kind == "phone":
                if 8 <= len(digits_of(value)) <= 15:
                    found.append((*m.span(), kind))
            elif kind == "ip":
                octets = list(map(int, value.split(".")))
                if max(octets) < 256 and octets[0] not in (0, 127):
                    found.append((*m.span(), kind))
            elif kind == "iban":
                packed = value.replace(" ", "")
                if int("".join(str(int(c, 36)) for c in packed[4:] + packed[:4])) % 97 == 1:
                    found.append((*m.span(), kind))
            elif kind == "ssn":
                if value[:3] not in ("000", "666") and value[0] != "9" and value[4:6] != "00" and value[7:] != "0000":
                    found.append((*m.span(), kind))
            elif luhn(digits_of(value)):
                found.append((*m.span(), "card"))
    if any(t in text for t in TITLE_STARTS):
        found += [(*m.span(2), "person") for m in PERSON.finditer(text)]
    found.sort()
    out, end = [], 0
    for x in found:
        if x[0] >= end:
            begin, end, kind = x
            value = text[begin:end]
            for _ in range(draws.get((kind, plain(kind, value)), 1) if draws else 1):
                value = SURROGATES[kind](value)
            out.append((begin, end, kind, value))
    return out


def replaced(text: str, found: list[tuple[int, int, str, str]]) -> str:
    parts, at = [], 0
    for begin, end, _, new in found:
        parts += [text[at:begin], new]
        at = end
    return "".join([*parts, text[at:]])


def with_surrogates(
    docs: DataFrame, text_col: str = "text", count_col: str | None = None, draws_col: str | None = None
) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; ``count_col``, if given, is added and holds the
    number of replacements. ``draws_col``, if given, holds an array of kind, original and draws
    of a row's entities, as ``redrawn`` finds them, and is left out.

    Null and empty texts stay as they are; all other columns, rows and repeated rows are kept;
    texts without entities don't change by a byte. Entities are mail addresses, phone, card,
    account and social security numbers, IPv4 addresses, secrets after a telling name, and
    persons after a title. Numbers with a wrong check digit are no cards or accounts.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != draws_col)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            more = batch.column(draws_col) if draws_col else [None] * len(batch)
            for value, drawn in zip(batch.column(place), more):
                text = value.as_py()
                draws = {(d["kind"], d["original"]): d["draws"] for d in drawn.as_py() or ()} if draws_col else None
                found = entities(text, draws) if text else []
                texts.append(replaced(text, found) if found else text)
                counts.append(len(found))
            out = batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
            if draws_col:
                out = out.drop_columns([draws_col])
            yield out.append_column(count_col, pa.array(counts, pa.int64())) if count_col else out

    return docs.mapInArrow(frugal(run), f"{kinds}, `{count_col}` long" if count_col else kinds)


def all_entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct ``kind``, ``original``, ``surrogate`` of a corpus; case of mail and format of
    numbers are taken away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {
                (kind, plain(kind, text[a:b]), plain(kind, new))
                for value in batch.column(0)
                if (text := value.as_py())
                for a, b, kind, new in entities(text)
            }
            columns = list(zip(*rows)) or [[], [], []]
            names = ["kind", "original", "surrogate"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names)

    return docs.select(text_col).mapInArrow(frugal(run), "kind string, original string, surrogate string").distinct()


def collisions(found: DataFrame) -> DataFrame:
    """Surrogates that stand for several originals, or equal their own original; none is expected."""
    return found.groupBy("kind", "surrogate").agg(
        F.count_distinct("original").alias("n"), F.max((F.col("original") == F.col("surrogate")).cast("int")).alias("same")
    ).where("n > 1 or same = 1")


def redrawn(found: DataFrame) -> DataFrame | None:
    """``kind``, ``original``, ``draws`` of those of ``all_entities`` whose surrogate has to be drawn
    more often than once so that all differ; None if there are none. Landed.

    Of the originals of one surrogate the first keeps it: that with the fewest draws, then the
    smallest. The others take the surrogate of their surrogate, turn by turn.
    """
    if collisions(found).isEmpty():
        return None
    table = land(found.withColumn("draws", F.lit(1)), "entities")
    first = Window.partitionBy("kind", "surrogate").orderBy(F.col("original") == F.col("surrogate"), "draws", "original")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values = batch.column("kind").to_pylist(), batch.column("surrogate").to_pylist()
            new = [plain(kind, SURROGATES[kind](value)) for kind, value in zip(kinds, values)]
            yield batch.set_column(batch.schema.get_field_index("surrogate"), "surrogate", pa.array(new, pa.string()))

    for _ in range(DRAWS):
        placed = table.withColumn("nth", F.row_number().over(first))
        placed = land(placed.withColumn("fine", (F.col("nth") == 1) & (F.col("original") != F.col("surrogate"))), "placed")
        wrong = placed.where("not fine").select("kind", "original", "surrogate", F.expr("draws + 1").cast("int").alias("draws"))
        if wrong.isEmpty():
            return land(table.where("draws > 1").select("kind", "original", "draws"), "draws")
        fine = placed.where("fine").select(wrong.columns)
        table = land(fine.unionByName(wrong.mapInArrow(frugal(again), wrong.schema)), "entities")
    raise RuntimeError(f"entities share a surrogate after {DRAWS} draws")


def distinct_surrogates(docs: DataFrame, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``with_surrogates`` after a check over all entities: no two of them share a surrogate."""
    draws = redrawn(all_entities(docs, text_col))
    if draws is None:
        return with_surrogates(docs, text_col, count_col)
    numbered = land(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (row, *entity)
                for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                if text
                for entity in {(kind, plain(kind, text[a:b])) for a, b, kind, _ in entities(text)}
            ]
            row, kind, original = zip(*rows) if rows else ((), (), ())
            columns = [pa.array(row, pa.int64()), pa.array(kind, pa.string()), pa.array(original, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["__row", "kind", "original"])

    held = numbered.select("__row", text_col).mapInArrow(frugal(run), "__row long, kind string, original string")
    per_row = (
        held.join(draws, ["kind", "original"])
        .groupBy("__row")
        .agg(F.collect_list(F.struct("kind", "original", "draws")).alias("__draws"))
    )
    return with_surrogates(numbered.join(per_row, "__row", "left").drop("__row"), text_col, count_col, "__draws")
