"""Personal data replaced by keyed surrogates of the same type, script, gender and format."""

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomere.llm.batches import id_and_text, slices
from sonomere.storage import written

# Ranges of characters that replace each other; case and script stay.
RANGES = [
    ("0", "9"), ("a", "z"), ("A", "Z"), ("à", "ö"), ("ø", "ÿ"), ("À", "Ö"), ("Ø", "Þ"),
    ("а", "я"), ("А", "Я"), ("α", "ρ"), ("σ", "ω"), ("Α", "Ρ"), ("Σ", "Ω"), ("א", "ת"), ("ء", "ي"),
    ("अ", "ह"), ("ぁ", "ん"), ("ァ", "ン"), ("가", "힣"), ("一", "龥"),
]
_RANGES = [(ord(a), ord(b) - ord(a) + 1) for a, b in RANGES]

# Titles, and given names by gender and script.
TITLES = {
    "m": "Mr Herr Señor Sr Monsieur Don Signor Господин Г-н".split(),
    "f": "Mrs Ms Miss Frau Señora Sra Madame Mme Doña Signora Госпожа Г-жа".split(),
    "": "Dr Prof Professor Доктор".split(),
}
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Marc Noah Oscar Paul".split(),
    ("f", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helen Ida Julia Karla Lena Maria Nora Olga Paula".split(),
    ("", "latin"): "Alex Chris Dana Eden Jean Jordan Kim Lee Morgan Pat Quinn Robin Sam Sasha Taylor Toni".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Ирина Лидия Мария Нина".split(),
    ("", "cyrillic"): "Саша Женя Валя Слава".split(),
}

_NAME = r"[^\W\d_a-zà-öø-ÿа-я][^\W\d_]+(?:-[^\W\d_]+)?"
_TITLE = "|".join(re.escape(t) for names in TITLES.values() for t in names)
DETECTORS = [
    ("email", re.compile(r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}")),
    ("secret", re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])")),
    ("ip", re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d])(?!\.\d)")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("phone", re.compile(
        r"(?<![\d+])(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]\d{3,4}(?!\d)"
        r"|(?<!\d)\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\d)"
        r"|(?<![\d.\-])\d{3}[.\- ]\d{3}[.\-]\d{4}(?![\d.\-]*\d)"
    )),
    ("card", re.compile(r"(?<![\d.])\d(?:[ \-]?\d){12,18}(?!\d)")),
]
_PERSON = re.compile(rf"(?<!\w)({_TITLE})\.? ({_NAME})(?: ({_NAME}))?")
_DIGITS = frozenset(("card", "phone", "ssn"))


def _luhn(digits: str) -> int:
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def find(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, value)`` of all entities; ``value`` is what co-referent ones share.

    Kinds are tried in order and claim their characters; a person is one entity per name, so that
    a surname stays the same with and without a given name.
    """
    out, taken = [], []

    def claim(start: int, end: int, kind: str, value: str) -> None:
        if all(end <= a or start >= b for a, b in taken):
            taken.append((start, end))
            out.append((start, end, kind, value))

    if _DIGIT_OR_AT.search(text):
        for kind, pattern in DETECTORS:
            for m in pattern.finditer(text):
                found = m.group()
                if kind == "ip" and any(int(x) > 255 for x in found.split(".")):
                    continue
                claim(*m.span(), *_value(kind, found))
    for m in _PERSON.finditer(text):
        gender = next(g for g, names in TITLES.items() if m.group(1) in names)
        names = [i for i in (2, 3) if m.group(i)]
        for i in names:
            kind = "surname" if i == names[-1] else f"given-{gender}"
            claim(*m.span(i), kind, m.group(i).lower())
    return sorted(out)


_DIGIT_OR_AT = re.compile(r"[0-9@]")


def _value(kind: str, found: str) -> tuple[str, str]:
    if kind == "email":
        return kind, found.lower()
    if kind == "ip":
        return kind, ".".join(str(int(x)) for x in found.split("."))
    if kind == "phone":
        return kind, re.sub(r"\D", "", _without_country(found))
    if kind == "card":
        digits = re.sub(r"\D", "", found)
        return ("card-valid" if _luhn(digits) == 0 else kind), digits
    if kind == "ssn":
        return kind, re.sub(r"\D", "", found)
    if kind == "iban":
        return kind, found.replace(" ", "")
    return kind, found.lower()


def _without_country(phone: str) -> str:
    return re.sub(r"^\+\d{1,3}(?=\D)", "", phone)


class Keyed:
    """Format-preserving permutations under a secret key."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def number(self, tweak: str, x: int) -> int:
        data = f"{tweak}|{x}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "big")

    def permute(self, tweak: str, x: int, n: int) -> int:
        """A permutation of 0 to n - 1: Feistel rounds, repeated until they land inside."""
        half = ((n - 1).bit_length() + 1) // 2 or 1
        mask = (1 << half) - 1
        while True:
            left, right = x >> half, x & mask
            for r in range(6):
                left, right = right, left ^ self.number(f"{tweak}|{half}|{r}", right) & mask
            x = left << half | right
            if x < n:
                return x

    def shaped(self, tweak: str, text: str) -> str:
        """Every character replaced by one of its range; different texts of one shape differ."""
        shape, x, n = [], 0, 1
        for c in text:
            of = next((r for r in _RANGES if r[0] <= ord(c) < r[0] + r[1]), None)
            shape.append(of or c)
            if of:
                x, n = x * of[1] + ord(c) - of[0], n * of[1]
        if n == 1:  # a script without a range
            return "".join("abcdefghijklmnop"[self.number(tweak + text, i) % 16] for i in range(8))
        x = self.permute(f"{tweak}|{[s if isinstance(s, str) else s[0] for s in shape]}", x, n)
        out = []
        for s in reversed(shape):
            if isinstance(s, str):
                out.append(s)
            else:
                x, rest = divmod(x, s[1])
                out.append(chr(s[0] + rest))
        return "".join(reversed(out))

    def surrogate(self, kind: str, value: str, attempt: int) -> str:
        """The ``attempt``-th surrogate of an entity."""
        # After some failures the value is lengthened, so that a small domain can't run out.
        tweak, value = f"{kind}|{attempt}", value + value[-1:] * (attempt // 8)
        if kind == "email":
            local, _, domain = value.rpartition("@")
            name, _, top = domain.rpartition(".")
            name = name.removesuffix(".example")
            host = self.shaped("domain", name or "mail")
            return f"{self.shaped(tweak, local)}@{host}.example.{top}"
        if kind == "ip":
            parts = [int(p) for p in value.split(".")] if attempt < 8 else [attempt, 0, 0, 0]
            x = self.permute(tweak, int.from_bytes(bytes(p % 256 for p in parts), "big"), 1 << 32)
            return ".".join(map(str, x.to_bytes(4, "big")))
        if kind == "card-valid":
            body = self.shaped(tweak, value[:-1])
            return body + str(-_luhn(body + "0") % 10)
        if kind == "secret":
            x = self.permute(f"{tweak}|{len(value)}", int(value, 16), 16 ** len(value))
            return f"{x:0{len(value)}x}"
        if kind == "iban":
            return value[:2] + self.shaped(tweak, value[2:])
        if kind.startswith("given"):
            script = "cyrillic" if "а" <= value[0] <= "я" else "latin" if value[0] < "ʰ" else ""
            names = GIVEN.get((kind.removeprefix("given-"), script), [])
            if names:
                # One name more with every attempt, so that a list never runs out.
                x, parts = self.number(tweak, int.from_bytes(value.encode(), "big")), []
                for _ in range(attempt + 1):
                    x, at = divmod(x, len(names))
                    parts.append(names[at].lower())
                return "-".join(parts)
        return self.shaped(tweak, value)



def fitted(kind: str, found: str, surrogate: str) -> str:
    """A surrogate written the way the entity was."""
    if kind.partition("-")[0] in _DIGITS:
        head = found[: len(found) - len(_without_country(found))] if kind == "phone" else ""
        digits, out = iter(surrogate), []
        for c in found[len(head) :]:
            out.append(next(digits, "") if c.isdigit() else c)
        return head + "".join(out) + "".join(digits)
    if kind == "iban":
        gaps = iter(surrogate)
        return "".join(" " if c == " " else next(gaps, "") for c in found) + "".join(gaps)
    if found.isupper():
        return surrogate.upper()
    if found[:1].isupper():
        return "-".join(p[:1].upper() + p[1:] for p in surrogate.split("-"))
    return surrogate


def _family(kind):
    """Kinds whose surrogates must differ from each other."""
    return F.split(kind, "-")[0]


def surrogate_table(entities: DataFrame, key: bytes) -> DataFrame:
    """``(kind, value, surrogate)``: no two entities of a family share a surrogate, and none is an
    entity that occurs itself.

    Permutations already differ within a format; what is left to check are lists of names,
    different formats and repeated attempts. Of entities that meet, the least value keeps the
    surrogate and the others try again. The table is joined, never collected.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed = Keyed(key)
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            made = [keyed.surrogate(k, v, a) for k, v, a in rows]
            yield batch.append_column("surrogate", pa.array(made, pa.string()))

    schema = "kind string, value string, attempt int, surrogate string"
    entities = written(entities.select("kind", "value").distinct(), "entities")
    originals = entities.select(_family(F.col("kind")).alias("family"), F.col("value").alias("surrogate"))
    originals = originals.distinct()
    settled, open_ = None, entities.withColumn("attempt", F.lit(0))
    while True:
        tried = open_.select("kind", "value", "attempt").mapInArrow(run, schema)
        tried = tried.withColumn("family", _family(F.col("kind"))).withColumn("old", F.lit(False))
        if settled is not None:
            tried = tried.unionByName(settled.withColumn("old", F.lit(True)))
        tried = written(tried, "surrogates")
        who = F.struct(~F.col("old"), "value", "kind")
        owners = tried.groupBy("family", "surrogate").agg(F.min(who).alias("owner"))
        real = originals.withColumn("real", F.lit(True))
        owners = owners.join(real, ["family", "surrogate"], "left")
        judged = tried.join(owners, ["family", "surrogate"])
        good = (F.col("owner") == who) & F.col("real").isNull()
        judged = written(judged.withColumn("good", good), "surrogates")
        settled = judged.filter("good").select("kind", "value", "attempt", "surrogate", "family")
        open_ = judged.filter("NOT good").withColumn("attempt", F.col("attempt") + 1)
        if open_.isEmpty():
            return settled.select("kind", "value", "surrogate")


_SPANS = "array<struct<start:int,end:int,kind:string,value:string>>"
_REPLACED = "array<struct<kind:string,start:int,end:int,surrogate:string>>"


def replace_entities(
    docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, text, n_replaced, replaced)`` of every row.

    E-mail addresses, IP addresses, phone, card and account numbers, social security numbers, hex
    secrets, and names after a title are replaced by surrogates made under ``key``. Equal entities
    get equal surrogates in all documents, different ones of a kind get different ones, and no
    surrogate is an entity of the table. ``replaced`` has the places in the new text.

    Digits, letters, case, script and separators stay in form; given names follow the title's
    gender; valid card numbers stay valid. Null text stays null; a text without an entity is
    returned as it is, without a shuffle; repeated rows are replaced each; an empty table gives
    an empty one; other columns are ignored. A very long text is searched and rewritten whole by one
    task. Names without a title before them in the same place are not found (README).
    """
    source = id_and_text(docs, doc_id, text)
    kind = source.schema["doc_id"].dataType.simpleString()

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keep = [t is None or not find(t) for t in part.column(1).to_pylist()]
                yield part.filter(pa.array(keep, pa.bool_()))

    def detect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "end", "kind", "value")
        for batch in batches:
            for part in slices(batch):
                spans = [find(t) if t else [] for t in part.column(1).to_pylist()]
                keep = pa.array([bool(s) for s in spans], pa.bool_())
                rows = [[dict(zip(names, s)) for s in found] for found in spans if found]
                yield part.filter(keep).append_column("spans", pa.array(rows, _arrow_spans))

    found = source.mapInArrow(detect, f"doc_id {kind}, text string, spans {_SPANS}")
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "found")
    each = found.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    table = surrogate_table(each, key)
    made = each.join(table, ["kind", "value"]).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "kind", "surrogate"))).alias("made")
    )
    joined = found.drop("spans").join(made, "row").select("doc_id", "text", "made")

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts, places = [], []
                for text, made in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    new, placed = _rewritten(text, made)
                    texts.append(new)
                    places.append(placed)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array(places, _arrow_replaced)],
                    ["doc_id", "text", "replaced"],
                )

    new = joined.mapInArrow(rewrite, f"doc_id {kind}, text string, replaced {_REPLACED}")
    same = source.mapInArrow(clean, f"doc_id {kind}, text string")
    same = same.withColumn("replaced", F.array().cast(_REPLACED))
    both = new.union(same)
    return both.select(
        "doc_id", "text", F.size("replaced").cast("bigint").alias("n_replaced"), "replaced"
    )


_arrow_spans = pa.list_(pa.struct([
    ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string()),
]))
_arrow_replaced = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string()),
]))


def _rewritten(text: str, made: list[dict]) -> tuple[str, list[dict]]:
    out, placed, at, length = [], [], 0, 0
    for m in made:
        new = fitted(m["kind"], text[m["start"] : m["end"]], m["surrogate"])
        out += [text[at : m["start"]], new]
        length += m["start"] - at
        placed.append({"kind": m["kind"], "start": length, "end": length + len(new), "surrogate": new})
        length += len(new)
        at = m["end"]
    return "".join([*out, text[at:]]), placed
