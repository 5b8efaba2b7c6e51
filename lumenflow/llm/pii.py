"""Personal data replaced by keyed surrogates.

``find``     a text -> its entities: kind, span, normal form
``surrogates``  the distinct entities of a corpus -> one surrogate each
``pseudonymise``  documents with every entity replaced

A surrogate is drawn from HMAC-SHA256(key, kind, normal form, round) and keeps
the original's type and look: an e-mail address keeps the lengths of its parts,
its digits and its top-level domain; digits of phone, card and account numbers
change place by place, country code, area-code brackets and separators stay,
card and IBAN check digits are right if the original's are; an IPv4 address is
four new bytes; a secret keeps its length and alphabet; a name keeps its title,
number of words and script, and its title's gender; upper case stays upper.

Equal normal forms get equal surrogates everywhere (coreference).  Distinctness
is checked: of the entities whose surrogates agree, and of those whose surrogate
is some original of the corpus, all but the first draw again with the next
round, until none is left.  A kind's space may be too small for that (more than
half of the one-letter addresses are in the corpus, a quoted secret is dashes only),
so from round ``SAME_LENGTH`` on the surrogate grows by a character a round, as names
do from the first; IPv4 addresses can't, and must be fewer than half of all there are.
The entity table is distributed and small beside the texts, which are never shuffled
unless they hold an entity.

An international phone number has 7 to 15 digits.

Defined results: null stays null, empty stays empty; rows that repeat come out
alike; an empty table gives none; other columns are untouched, but for one named
``n_entities``, which the count replaces.  A text is read in time linear in its length,
whatever its words.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.llm.words import small_batches, text_lists
from lumenflow.session import materialize

# fixed values: titles and the gender they tell, by script
_TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "Г-жа", "Госпожа", "Κα"],
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Господин", "Κος"],
    "n": ["Dr", "Prof"],
}
_GIVEN = {
    ("latin", "f"): ["Anna", "Clara", "Elena", "Julia", "Laura", "Marta", "Nora", "Sophie"],
    ("latin", "m"): ["Adrian", "David", "Felix", "Jonas", "Lucas", "Martin", "Oscar", "Simon"],
    ("cyrillic", "f"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Ольга"],
    ("cyrillic", "m"): ["Антон", "Борис", "Игорь", "Олег", "Павел", "Сергей"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Μαρία"],
    ("greek", "m"): ["Γιάννης", "Κώστας", "Νίκος", "Πέτρος"],
}
_SYLLABLES = {
    "latin": ["ba", "den", "fal", "gor", "hen", "kel", "lor", "man", "ner", "pol", "ras", "sen", "tor", "ven", "wil", "zan"],
    "cyrillic": ["бал", "вор", "гор", "дан", "зер", "кол", "лен", "мар", "нов", "пол", "рог", "сав", "тал", "фед", "хар", "чер"],
    "greek": ["βασ", "γεω", "δημ", "ζαν", "θεο", "καλ", "λαμ", "μαρ", "νικ", "παπ", "ραφ", "σαρ", "ταν", "φιλ", "χαρ", "ψαρ"],
}
_ENDINGS = {("latin", "f"): "", ("latin", "m"): "", ("cyrillic", "f"): "ова", ("cyrillic", "m"): "ов",
            ("greek", "f"): "ου", ("greek", "m"): "ης"}

_TITLE = "|".join(re.escape(t) for ts in _TITLES.values() for t in sorted(ts, key=len, reverse=True))
_GENDER = {t: g for g, ts in _TITLES.items() for t in ts}
_WORD = r"[^\W\d_][^\W\d_'’-]+"
# the part before the @ is a whole run of its characters, taken once and never given back,
# so a long word without an @ is read once
_MAIL = r"(?=[.+%-]*+\w)[\w.+%-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}"
# in the order of precedence where two start at one place
_PATTERNS: list[tuple[str, str]] = [
    ("email", rf"(?P<email>(?<![\w.+%-]){_MAIL})"),
    ("secret", r"(?P<secret>(?<=[\"'])[A-Za-z0-9_\-/+]{20,}(?=[\"'])|\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{32,})\b)"),
    ("iban", r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"),
    ("ipv4", r"(?P<ipv4>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"),
    ("card", r"(?P<card>(?<![\d.+-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d-]))"),
    ("phone", r"(?P<phone>(?<![\w+])\+\d{1,3}(?:[ .-]?(?:\(\d{1,4}\)|\d{1,4})){2,5}(?!\d)|(?<![\w+(])(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4}(?!\d))"),
    ("ssn", r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"),
    ("name", rf"(?P<name>\b(?:{_TITLE})\.? {_WORD}(?: {_WORD})?)"),
]
_ANY = re.compile("|".join(p for _, p in _PATTERNS))
_MAIL_HERE = re.compile(_MAIL)
_MAIL_RUN = re.compile(r"[\w.+%-]*+")
_MAYBE = re.compile(rf"[0-9@]|(?:{_TITLE})\b|[\"'][A-Za-z0-9_\-/+]{{20}}")
_KEYS = ("AKIA", "sk-", "ghp_", "gho_", "ghu_", "ghs_", "ghr_")
_NAME = re.compile(rf"({_TITLE})(\.?) (.*)", re.S)
_IPV4 = re.compile(dict(_PATTERNS)["ipv4"])
_RUN = re.compile(r"(\d+)\)?")

SAME_LENGTH = 4         # rounds in which a surrogate keeps its original's length
PHONE_DIGITS = 7, 15    # of an international number, country code and all

Entity = tuple[int, int, str, str]


def _normal(kind: str, raw: str) -> str:
    if kind == "email":
        return raw.lower()
    if kind in ("card", "ssn", "iban"):
        return re.sub(r"[ -]", "", raw)
    if kind == "phone":
        return "+" * raw.startswith("+") + re.sub(r"\D", "", raw)
    if kind == "secret":
        return raw.lower() if re.fullmatch(r"[0-9a-fA-F]+", raw) else raw
    if kind == "name":
        title, _, rest = _NAME.match(raw).groups()
        return _GENDER[title] + " " + " ".join(rest.casefold().split())
    return raw


def _phone_end(text: str, a: int, b: int) -> int | None:
    """Where the phone number in ``text[a:b]`` ends: after the last run of digits
    that it can hold, and before an address that starts behind a whole number; None
    if too few are left."""
    if text[a] != "+":
        return b
    end, digits = None, 0
    # an address has 15 characters at most, and what follows it decides
    addresses = {m.start() for m in _IPV4.finditer(text, a, b + 17)}
    for run in _RUN.finditer(text, a, b):
        digits += len(run[1])
        if digits > PHONE_DIGITS[1] or end is not None and run.start() in addresses:
            break
        if digits >= PHONE_DIGITS[0]:
            end = run.end()
    return end


def find(text: str | None) -> list[Entity]:
    """(from, to, kind, normal form) of each entity, left to right, apart."""
    if not text or not (_MAYBE.search(text) or any(k in text for k in _KEYS)):
        return []
    out, at, no_mail = [], 0, 0
    while True:
        # an entity may end inside a run that goes on to an address; the pattern starts
        # at a run's start only, and a run is looked at once
        m, mail = None, False
        if out and at == out[-1][1] and at >= no_mail:
            m = _MAIL_HERE.match(text, at)
            mail = m is not None
            no_mail = 0 if mail else _MAIL_RUN.match(text, at).end() + 1
        m = m or _ANY.search(text, at)
        if m is None:
            break
        kind, (a, b) = "email" if mail else m.lastgroup if m.lastgroup != "gap" else "card", m.span()
        at = b
        if kind == "name":      # a title is one only before a capital; a second word must look like the first
            words = _NAME.match(m[0])[3].split(" ")
            if not words[0][0].isupper():
                at = a + 1
                continue
            if len(words) > 1 and not (words[1].istitle() or words[0].isupper() and words[1].isupper()):
                at = b = b - len(words[1]) - 1
        if kind == "phone":
            if (end := _phone_end(text, a, b)) is None:
                at = a + 1
                continue
            at = b = end
        out.append((a, b, kind, _normal(kind, text[a:b])))
    return out


class _Draw:
    """A stream of numbers from HMAC-SHA256 of key and entity."""

    def __init__(self, key: bytes, *parts: str) -> None:
        self.key, self.seed, self.n, self.left = key, "\x1f".join(parts), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, f"{self.seed}\x1f{self.n}".encode(), hashlib.sha256).digest()
            self.n += 1
        x, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return x % n

    def like(self, c: str) -> str:
        """Another character of the same class."""
        if c.isdigit():
            return "0123456789"[self.below(10)]
        if "a" <= c <= "z":
            return chr(97 + self.below(26))
        if "A" <= c <= "Z":
            return chr(65 + self.below(26))
        return c


def _luhn(digits: str) -> int:
    """The check digit of ``digits``."""
    total = sum(d if i % 2 else (2 * d - 9 * (d > 4)) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def _iban_check(country: str, rest: str) -> str:
    number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{98 - number % 97:02d}"


def _script(word: str) -> str:
    code = ord(word[0])
    return "cyrillic" if 0x400 <= code < 0x530 else "greek" if 0x370 <= code < 0x400 or 0x1F00 <= code < 0x2000 else "latin"


def draw_surrogate(key: bytes, kind: str, normal: str, round_: int) -> str:
    """The surrogate's normal form, of the same length and alphabet (names: the
    same number of words and script); they grow with the round, names from the
    first, others from ``SAME_LENGTH`` on."""
    d = _Draw(key, kind, normal, str(round_))
    more = max(0, round_ - SAME_LENGTH + 1)
    if kind == "email":
        local, _, domain = normal.partition("@")
        host, _, top = domain.rpartition(".")
        # letters beyond ASCII become ASCII, so that the address stays one
        return "".join(d.like(c if c.isascii() else "a") for c in local + "a" * more) + "@" + "".join(map(d.like, host)) + "." + top
    if kind == "ipv4":
        return ".".join(str(1 + d.below(223) if not i else d.below(256)) for i in range(4))
    if kind == "card":
        body = "".join(map(d.like, normal[:-1] + "0" * more))
        return body + (str(_luhn(body)) if _luhn(normal[:-1]) == int(normal[-1]) else d.like("0"))
    if kind == "iban":
        rest = "".join(map(d.like, normal[4:] + "0" * more))
        real = normal[2:4] == _iban_check(normal[:2], normal[4:])
        return normal[:2] + (_iban_check(normal[:2], rest) if real else d.like("0") + d.like("0")) + rest
    if kind == "phone":
        keep = 2 if normal.startswith("+") else 0           # the plus and the country code's first digit
        return normal[:keep] + "".join(map(d.like, normal[keep:] + "0" * more))
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+", normal):
            return "".join("0123456789abcdef"[d.below(16)] for _ in range(len(normal) + more))
        head = re.match(r"(?:AKIA|gh[pousr]_|sk-)?", normal)[0]
        return head + "".join(map(d.like, normal[len(head):] + "a" * more))
    if kind == "name":
        gender, *words = normal.split(" ")
        out = []
        for i, word in enumerate(words):
            script = _script(word)
            sex = gender if gender in "fm" else "fm"[d.below(2)]
            if len(words) > 1 and not i:
                given = _GIVEN[script, sex]
                out.append(given[d.below(len(given))])
            else:
                parts = _SYLLABLES[script]
                out.append(("".join(parts[d.below(len(parts))] for _ in range(3 + round_)) + _ENDINGS[script, sex]).capitalize())
        return gender + " " + " ".join(out)
    return "".join(map(d.like, normal + "0" * more))


def dress(kind: str, raw: str, surrogate: str) -> str:
    """The surrogate in the original's clothes: separators, case, title."""
    if kind in ("card", "ssn", "iban", "phone"):
        source = iter(surrogate)
        return "".join(next(source) if c.isalnum() or c == "+" else c for c in raw) + "".join(source)
    if kind == "name":
        title, dot, rest = _NAME.match(raw).groups()
        name = surrogate.split(" ", 1)[1]
        return f"{title}{dot} {name.upper() if rest.isupper() else name}"
    if kind in ("email", "secret") and raw.upper() == raw and raw.lower() != raw:
        return surrogate.upper() if kind == "email" or re.fullmatch(r"[0-9A-F]+", raw) else surrogate
    return surrogate


def _drawn(entities: DataFrame, key: bytes, round_: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            kinds, normals = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([draw_surrogate(key, k, n, round_) for k, n in zip(kinds, normals)], pa.string())],
                names=["kind", "normal", "surrogate"])
    return entities.select("kind", "normal").mapInArrow(run, "kind string, normal string, surrogate string")


def surrogates(entities: DataFrame, key: bytes, draw: Callable = _drawn) -> DataFrame:
    """(kind, normal, surrogate), one to one: no two entities share a surrogate,
    and no surrogate is an original."""
    entities = materialize(entities.select("kind", "normal").distinct(), "entities")
    originals = entities.select("kind", F.col("normal").alias("surrogate"), F.lit(True).alias("real"))
    settled, todo, round_ = None, entities, 0
    while True:
        fresh = draw(todo, key, round_).withColumn("round", F.lit(round_))
        table = fresh if settled is None else settled.unionByName(fresh)
        # earlier rounds hold their surrogate, then the first in text order
        first = table.groupBy("kind", "surrogate").agg(F.min(F.struct("round", "normal")).alias("first"))
        table = (table.join(first, ["kind", "surrogate"]).join(originals, ["kind", "surrogate"], "left")
                 .withColumn("ok", (F.col("first.normal") == F.col("normal")) & F.col("real").isNull()))
        table = materialize(table.select("kind", "normal", "surrogate", "round", "ok"), "drawn")
        settled, todo = table.where("ok").drop("ok"), table.where("not ok").select("kind", "normal")
        if todo.isEmpty():
            return settled.select("kind", "normal", "surrogate")
        round_ += 1


_FOUND = "array<struct<a:int,b:int,kind:string,normal:string>>"


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with every entity of ``text`` replaced, all columns, and their number
    ``n_entities`` (a column of that name in ``docs`` is replaced).  Texts are searched
    once: what is found is written beside them.  Rows without an entity pass through
    where they lie."""
    docs = docs.drop("n_entities")
    names = docs.columns
    key_of = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    mine = docs.withColumns({"_lf_id": F.col("doc_id").cast("long"), "_lf_key": key_of, "_lf_found": F.lit(None).cast(_FOUND)})
    place = names.index("text")

    def search(batches):
        for batch in batches:
            found = [[{"a": a, "b": b, "kind": kind, "normal": normal} for a, b, kind, normal in find(t)]
                     for _, texts in text_lists(batch, "text") for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, batch.schema.field("_lf_found").type)],
                                             names=batch.schema.names)

    with small_batches(docs.sparkSession):
        searched = materialize(mine.mapInArrow(search, mine.schema), "searched")
    some = F.size("_lf_found") > 0
    held = materialize(searched.where(some).select("_lf_id", "_lf_key", F.explode("_lf_found").alias("e"))
                       .select("_lf_id", "_lf_key", "e.kind", "e.normal").distinct(), "held")
    given = held.join(surrogates(held, key), ["kind", "normal"])
    lists = given.groupBy("_lf_id", "_lf_key").agg(F.collect_list(F.struct("kind", "normal", "surrogate")).alias("_lf_given"))

    def replace(batches):
        for batch in batches:
            new, counts = [], []
            given_lists, found_lists = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_lf_given", "_lf_found"))
            texts = (t for _, part in text_lists(batch, "text") for t in part)
            for text, given_list, found in zip(texts, given_lists, found_lists):
                table = {(g["kind"], g["normal"]): g["surrogate"] for g in given_list}
                out, at = [], 0
                for e in found:
                    out += [text[at:e["a"]], dress(e["kind"], text[e["a"]:e["b"]], table[e["kind"], e["normal"]])]
                    at = e["b"]
                new.append("".join(out) + text[at:])
                counts.append(len(found))
            column = pa.array(new, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(
                [*(column if i == place else batch.column(i) for i in range(len(names))), pa.array(counts, pa.int64())],
                names=[*names, "n_entities"])

    clean = searched.where(~some).select(*names, F.lit(0).cast("long").alias("n_entities"))
    dirty = searched.where(some).alias("d").join(
        lists.alias("l"), F.col("d._lf_id").eqNullSafe(F.col("l._lf_id")) & (F.col("d._lf_key") == F.col("l._lf_key"))).select(
        *[F.col(f"d.{n}") for n in names], "_lf_found", "_lf_given")
    # StructType.add changes its object in place, so the columns are copied first
    out = type(docs.schema)(list(docs.schema.fields)).add("n_entities", "long")
    return clean.unionByName(dirty.mapInArrow(replace, out))
