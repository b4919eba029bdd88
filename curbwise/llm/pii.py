"""Personal data: keyed surrogates of the same type, gender, script and format.

1. Documents that cannot hold an entity are told apart by one built-in pattern
   and go through untouched. The others are searched (``detect``) and give one
   row per (text digest, entity); an entity is a type with a normal form, so
   "+1 (017) 555-7713" and "+10175557713" are one.
2. Surrogates are made for the distinct entities of the whole corpus from an
   HMAC of (key, type, normal form, attempt). A collision check compares them
   with each other and with every real entity of the type: of entities with
   one surrogate the first keeps it, the others, and those whose surrogate is
   real, try again. What is left after ``MAX_ROUNDS`` gets a form that no
   entity of its type can have, with 96 bits of the HMAC or more. Distinct entities so
   keep distinct surrogates and one entity has one surrogate everywhere.
3. Each text digest gets the list of its entities' surrogates and the texts are
   rewritten; every occurrence keeps its own separators and letter case.

Surrogates: letters become letters of their script (vowels stay vowels),
digits digits; e-mail domains keep their ending and telephone numbers their
country code; card numbers keep their first
digit and a valid check digit; addresses are valid and private ones stay
private (later attempts of 192.168 and 172.16-31 are in 10.0.0.0/8, which is
wider); given names end as names of the gender do that their titled mentions in the
corpus agree on, and one given name has one surrogate whatever its titles. Names are
known by a title; a person whose title never stands before the name is not found.
The forms of last resort (step 2) leave the format of their type.

Cases: null and empty texts stay as they are; very long texts are searched
whole, in time that grows with their length; repeated rows get the same replacement; an empty table gives an empty
result; further columns pass through whatever their names.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from curbwise.llm.common import free_name, saved, ship

DEFAULT_KEY = "corpus-surrogates-1"
MAX_ROUNDS = 40
#: Attempts that keep the first two numbers of a private address.
NARROW = 8

# Titles that name a person's gender (f, m) or none (n).
TITLES = {
    "mr": "m", "herr": "m", "monsieur": "m", "señor": "m", "г-н": "m",
    "mrs": "f", "ms": "f", "miss": "f", "frau": "f", "madame": "f", "mme": "f", "señora": "f", "г-жа": "f",
    "dr": "n", "prof": "n",
}
# Vowels and consonants by script, and endings of given names by gender.
ALPHABETS = {
    "latin": ("aeiou", "bcdfghjklmnpqrstvwxyz"),
    "cyrillic": ("аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ"),
    "greek": ("αεηιουω", "βγδζθκλμνξπρστφχψ"),
}
ENDINGS = {("latin", "f"): "a", ("latin", "m"): "n", ("cyrillic", "f"): "а", ("cyrillic", "m"): "н", ("greek", "f"): "α", ("greek", "m"): "ς"}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"[^\W\d_a-zß-öø-ÿа-яα-ω][^\W\d_]+(?:['’-][^\W\d_]+)*"
#: What stands after the sign of an e-mail address, and a character that may stand before it.
_DOMAIN = re.compile(r"[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+")
_LOCAL = re.compile(r"[\w.%+-]")
#: Searched after e-mail addresses, in this order; text taken by an earlier one is not searched again.
PATTERNS = (
    ("secret", re.compile(r"""(?i)(?<![a-z])(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)["']?\s*[=:]\s*["']?([\w+/.-]{8,})""")),
    ("secret", re.compile(r"(?<![0-9A-Za-z])((?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|(?=[0-9]*[a-fA-F])[0-9a-fA-F]{32,}))(?![0-9A-Za-z])")),
    ("iban", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")),
    ("card", re.compile(r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?!\d)")),
    ("ip", re.compile(rf"(?<!\d)(?<!\d\.)(?:{_OCTET}\.){{3}}{_OCTET}(?!\d)(?!\.\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("phone", re.compile(r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{4}(?!\d)|(?<![\d+])\+\d{8,15}(?!\d)")),
)
_TITLED = re.compile(rf"(?<!\w)((?i:{'|'.join(TITLES)}))\.?[ \t]+({_NAME}(?:[ \t]+{_NAME}){{0,2}})")
# A decimal digit beyond ASCII; planes above the first gain digits with each Unicode version, which Java and Python need not share.
_DIGIT = r"[\x{660}-\x{10FFFF}&&[\p{Nd}\x{10000}-\x{10FFFF}]]"
#: What any text with an entity matches, for Spark (Java). An address without two digits in a row has four single ones.
MAYBE = (rf"@|[0-9](?:[0-9]|(?:\.[0-9]){{3}})|{_DIGIT}|(?<![A-Za-z])(?:AKIA|gh[pousr]_|[0-9a-fA-F]{{32}}"
         rf"|(?iu:token|secret|passw|api[_-]?key|access[_-]?key|(?:{'|'.join(TITLES)})\.?[ \t]))")


def _script(word: str) -> str:
    c = word[:1].lower()
    return "cyrillic" if "а" <= c <= "я" else "greek" if "α" <= c <= "ω" else "latin"


def normal(kind: str, found: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return "".join(c for c in found if c.isdigit())
    if kind == "iban":
        return found.replace(" ", "")
    return found if kind == "ip" else found.lower()


#: A run of letters, with others joined to it, that no letter, digit or underscore touches.
_WORD = re.compile(r"(?<!\w)[^\W\d_]++(?:['’-][^\W\d_]++)*(?!\w)")
_JOINED = re.compile("['’-]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of e-mail addresses: from each sign to the left as far as its characters go, so that
    long runs without a sign cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > last and _LOCAL.match(text, a - 1):
            a -= 1
        domain = _DOMAIN.match(text, at + 1) if a < at else None
        if domain:
            yield a, domain.end()
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", last)


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) of every entity, in order and apart from each other."""
    out: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))

    def take(a: int, b: int, kind: str, form: str) -> None:
        if b > a and not any(taken[a:b]):
            taken[a:b] = b"\1" * (b - a)
            out.append((a, b, kind, form))

    for a, b in _emails(text):
        take(a, b, "email", normal("email", text[a:b]))
    for kind, pattern in PATTERNS:
        for m in pattern.finditer(text):
            a, b = m.span(1) if kind == "secret" else m.span()
            if kind == "secret" and not any(c.isalpha() or c.isdigit() for c in text[a:b]):
                continue  # a blank of a form
            take(a, b, kind, normal(kind, text[a:b]))
    words: dict[str, tuple[str, str]] = {}
    for m in _TITLED.finditer(text):
        gender = TITLES[m[1].lower()]
        parts = list(re.finditer(_NAME, m[2]))
        for i, p in enumerate(parts):
            # the last word is the family name; words before it carry the gender
            kind = "family" if i == len(parts) - 1 else f"given-{gender}"
            take(m.start(2) + p.start(), m.start(2) + p.end(), kind, p[0].casefold())
            words.setdefault(p[0], (kind, p[0].casefold()))
    if words:  # the same person without a title
        parts_most = max(len(_JOINED.split(w)) for w in words)
        for m in _WORD.finditer(text):
            cuts = [m.start(), *(x for j in _JOINED.finditer(m[0]) for x in (m.start() + j.start(), m.start() + j.end())), m.end()]
            i = 0
            while i < len(cuts):  # the longest known name from each part on
                for j in range(min(len(cuts), i + 2 * parts_most) - 1, i, -2):
                    if (known := words.get(text[cuts[i]:cuts[j]])):
                        take(cuts[i], cuts[j], *known)
                        i = j - 1
                        break
                i += 2
    return sorted(out)


class _Stream:
    """Numbers from an HMAC of the key and what is replaced."""

    def __init__(self, key: str, kind: str, form: str, attempt: int):
        self._key, self._seed, self._n, self._left = key.encode(), f"{kind}\0{form}\0{attempt}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self._left) < 4:
            self._left = hmac.new(self._key, self._seed + self._n.to_bytes(4, "big"), hashlib.sha256).digest()
            self._n += 1
        x, self._left = int.from_bytes(self._left[:4], "big"), self._left[4:]
        return x * n >> 32


def _swap(text: str, s: _Stream) -> str:
    """Letters for letters of the script, digits for digits; the rest stays."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(s.below(10)))
        elif c.isalpha():
            vowels, consonants = ALPHABETS[_script(c)]
            pool = vowels if c.lower() in "aeiouáéíóúäöüàèìòùâêîôûëïаеёиоуыэюяαεηιουωάέήίόύώ" else consonants
            out.append(pool[s.below(len(pool))])
        else:
            out.append(c)
    return "".join(out)


def _check_digit(digits: str) -> str:
    """The digit that makes ``digits`` plus it pass the card check sum."""
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


def surrogate(key: str, kind: str, form: str, attempt: int = 0) -> str:
    """The normal form of the replacement; later attempts of short forms are longer."""
    s = _Stream(key, kind, form, attempt)
    if kind == "email":
        local, _, domain = form.partition("@")
        host, dot, ending = domain.rpartition(".")
        d = _Stream(key, "domain", domain, 0)  # one domain, one replacement
        more = "".join(ALPHABETS["latin"][1][s.below(21)] for _ in range(max(0, attempt - 2)))
        return f"{_swap(local, s)}{more}@{_swap(host, d)}{dot}{ending}"
    if kind == "secret":
        hexes = all(c in "0123456789abcdef" for c in form)
        letters = lambda c: "abcdef"[s.below(6)] if hexes else _swap(c, s)
        return "".join(str(s.below(10)) if c.isdigit() else letters(c) for c in form + "b" * max(0, attempt - 2))
    if kind == "card":
        body = form[0] + "".join(str(s.below(10)) for _ in form[2:])
        return body + _check_digit(body)
    if kind == "ip":
        a, b, *_ = (int(x) for x in form.split("."))
        if a in (10, 127):
            kept = [a]
        elif (a, b) == (192, 168) or a == 172 and 16 <= b < 32:
            kept = [a, b] if attempt < NARROW else [10]
        else:  # a public first number stays clear of the private ranges
            kept = [[x for x in range(1, 224) if x not in (10, 127, 172, 192)][s.below(219)]]
        return ".".join(map(str, kept + [s.below(256) for _ in range(3 - len(kept))] + [1 + s.below(254)]))
    if kind == "iban":
        return form[:2] + "".join(str(s.below(10)) if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[s.below(26)] for c in form[2:])
    if kind in ("phone", "ssn"):  # digits before the last ten are a country code
        return form[:-10] + "".join(str(s.below(10)) for _ in form[-10:])
    body = _swap(form, s)  # names
    script, gender = _script(form), kind[-1]
    pool = ALPHABETS[script]
    body += "".join(pool[i % 2][s.below(len(pool[i % 2]))] for i in range(max(0, attempt - 1)))
    end = ENDINGS.get((script, gender)) if kind.startswith("given") else None
    return body[:-1] + end if end else body


def unbounded(key: str, kind: str, form: str) -> str:
    """A replacement from 96 bits of the HMAC or more, longer than the patterns of its type find or not of their form."""
    s = _Stream(key, f"last-{kind}", form, 0)
    if kind == "ip":  # IPv6: unique local ones for private addresses, documentation ones for others
        a, b, *_ = (int(x) for x in form.split("."))
        private = a in (10, 127) or (a, b) == (192, 168) or a == 172 and 16 <= b < 32
        return ":".join([*(["fd00"] if private else ["2001", "db8"]), *(f"{s.below(1 << 16):x}" for _ in range(7 if private else 6))])
    if kind in ("card", "iban", "phone", "ssn"):
        kept = form[:{"card": 1, "iban": 2}.get(kind, -10)]
        return kept + "".join(str(s.below(10)) for _ in range(39))
    more = "".join("bcdf"[s.below(4)] for _ in range(64))
    if kind == "email":
        local, _, domain = surrogate(key, kind, form).partition("@")
        return f"{local}{more}@{domain}"
    end = surrogate(key, kind, form)
    return end[:-1] + more + end[-1] if kind.startswith("given") else end + more


def render(found: str, new: str, kind: str) -> str:
    """The surrogate's normal form in the separators and letter case of an occurrence."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in found) + "".join(digits)
    if kind == "iban":
        letters = iter(new)
        return "".join(c if c == " " else next(letters) for c in found) + "".join(letters)
    if kind == "ip":
        return new
    if found.isupper():
        return new.upper()
    if len(new) == len(found):
        return "".join(n.upper() if f.isupper() else n for f, n in zip(found, new))
    return new[:1].upper() + new[1:] if found[:1].isupper() else new


def rewrite(text: str, new: dict[tuple[str, str], str]) -> tuple[str, int]:
    out, at, hits = [], 0, detect(text)
    for a, b, kind, form in hits:
        out += [text[at:a], render(text[a:b], new[kind, form], kind)]
        at = b
    return "".join([*out, text[at:]]), len(hits)


# --- jobs ---------------------------------------------------------------------------------------

def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """(digest, kind, form): the distinct entities of each text that can hold one."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d, k, f) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for k, f in sorted({x[2:] for x in detect(t)})]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (list(zip(*rows)) or [()] * 3)], ["digest", "kind", "form"])

    t = F.col(f"`{text}`")
    return docs.filter(t.rlike(MAYBE)).select(F.md5(t), t).mapInArrow(run, "digest string, kind string, form string").distinct()


def assign(entities: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """(kind, form, surrogate) of distinct entities, after as many rounds as collisions need."""
    def attempt(rows: DataFrame, n: int | None) -> DataFrame:
        make = surrogate if n is not None else lambda k, kind, form, _: unbounded(k, kind, form)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                made = [make(key, k, f, n) for k, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], ["kind", "form", "surrogate"])

        return rows.select("kind", "form").mapInArrow(run, "kind string, form string, surrogate string")

    real = entities.select("kind", F.col("form").alias("surrogate"), F.lit(True).alias("real"))
    todo, done = entities, None
    for n in range(MAX_ROUNDS):
        made = saved(attempt(todo, n), "pii-round")
        first = made.groupBy("kind", "surrogate").agg(F.min("form").alias("first"))
        judged = made.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        if done is not None:
            judged = judged.join(done.select("kind", "surrogate", F.lit(True).alias("used")), ["kind", "surrogate"], "left")
            judged = judged.withColumn("real", F.coalesce("real", "used"))
        judged = saved(judged.select("kind", "form", "surrogate", (F.col("real").isNull() & (F.col("form") == F.col("first"))).alias("ok")), "pii-judged")
        won = judged.filter("ok").select("kind", "form", "surrogate")
        done = won if done is None else done.unionAll(won)
        todo = judged.filter("NOT ok")
        if todo.isEmpty():
            return done
    return done.unionAll(attempt(todo, None))


def _one_gender(found: DataFrame) -> DataFrame:
    """``found`` with ``named``: a given name has the gender that its titled mentions in the corpus
    agree on, so that a name is one entity whatever title stands before it."""
    given = F.col("kind").startswith("given-")
    said = F.array_sort(F.array_remove(F.collect_set("kind"), "given-n"))  # at most two
    names = found.filter(given).groupBy("form").agg(F.when(F.size(said) == 1, said[0]).otherwise("given-n").alias("resolved"))
    names = names.withColumn("is_given", F.lit(True))
    got = found.withColumn("is_given", given).join(names, ["form", "is_given"], "left")
    return got.select("digest", "kind", "form", F.coalesce("resolved", "kind").alias("named"))


def replace(docs: DataFrame, text: str = "text", key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with surrogates in ``text`` and, as last column, ``pii_count`` (replacements made)."""
    names = docs.columns
    count, d, m = (free_name(names, n) for n in ("pii_count", "__digest", "__new"))
    found = saved(_one_gender(saved(find(docs, text), "pii-found")), "pii-named")
    new = assign(saved(found.select(F.col("named").alias("kind"), "form").distinct(), "pii-entities"), key)
    lists = found.join(new.withColumnRenamed("kind", "named"), ["named", "form"]).groupBy("digest").agg(F.collect_list(F.struct("kind", "form", "surrogate")).alias(m))
    t = F.col(f"`{text}`")
    keep = [F.col(f"`{c}`") for c in names]
    may = F.coalesce(t.rlike(MAYBE), F.lit(False))
    plain = docs.filter(~may).select(*keep, F.lit(0).cast("long").alias(count))
    rest = docs.filter(may).select(*keep, F.md5(t).alias(d))
    rest = rest.join(lists.withColumnRenamed("digest", d), d, "left").select(*keep, F.col(m))
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for old, table in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist()):
                got, n = rewrite(old, {(x["kind"], x["form"]): x["surrogate"] for x in table}) if table else (old, 0)
                texts.append(got)
                counts.append(n)
            cols = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], names=[f"c{i}" for i in range(len(names) + 1)])

    # numbered columns on the way: names may hold any character
    kinds = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(plain.schema.fields)])
    return plain.unionAll(rest.toDF(*[f"c{i}" for i in range(len(names) + 1)]).mapInArrow(run, kinds))
