"""Personal data in texts: fixed patterns, and a conditional random field for other forms.

The patterns find e-mail and IP addresses, card and phone numbers in their usual forms.
The field, trained from a small labelled table, adds forms they miss: spelled-out or
accented addresses, IPv6 and bracketed IP addresses, phone numbers without a plus sign,
and card numbers that are named as such. What it finds within or across a pattern's span,
or what cannot be of its kind, is left out, so the spans of the patterns stay as they are.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import crf
from linkweave.llm.text import texts_of

# The kinds, in the order in which equal places are listed.
KINDS = ["email", "ip", "card", "phone"]

# Rows of the labelled table that are learned from; the field is fitted on the driver.
MAX_EXAMPLES = 2_000
EXAMPLES = 840

# Characters of a text that are decoded at once; a unit of the field is never cut.
PIECE = 500_000
# Texts are joined up to this length before they are cut into tokens.
GROUP = 200_000

_SPAN = "struct<kind:string,start:bigint,end:bigint>"
SPANS = f"array<{_SPAN}>"

# Characters of the part of an address before the @.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A number has to begin where its digits do, as any later start fails like this one.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            if domain:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    doubled = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of what the patterns find, by start, then kind."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) < 4 and int(p or "0") <= 255 for p in parts):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdecimal() for c in m.group()) <= 15:
                    found.append(("phone", *m.span()))
    return in_order(found)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# The labelled table: sentences with <kind>...</kind> marks. {w} and {W} are any words, {p} is prose, {j}
# junk, # any digit, {v} a number up to 255, {x} four hexadecimal digits.
_MARKED = [
    "call <phone>(###) 555-####</phone> {w} {w}",
    "{W} {w} phone <phone>### 555 ####</phone> {w}.",
    "{W} tel. <phone>###-555-####</phone>, {w}",
    "tel: <phone>0## ### ## ##</phone> {w}",
    "{w} mobile <phone>07## ### ####</phone> {W}",
    "{W} fax <phone>0##/#######</phone>.",
    "{w} <phone>+1 (###) 555-####</phone> {w} {w}",
    "{w} {w} <phone>+## ## ########</phone>",
    "{W} {w} <phone>00## ### #######</phone> {w}",
    "{W} <phone>+1 (###) 555-####</phone> {w} <phone>(###) 555-####</phone> {w}.",
    "{w} <phone>(###) ###-####</phone>, <phone>###-###-####</phone>",
    "my number is <phone>###.555.####</phone> {w}",
    "{w} at <phone>(###) ###-####</phone> {w} {w} {w}",
    "write to <email>{w}@{w}</email> {w}",
    "{w} <email>{w}.{w} (at) {w}.org</email>, {w}",
    "mail <email>{w} [at] {w} [dot] com</email> {w} {w}",
    "{W} {w} <email>{w}(at){w}.net</email> {w}",
    "{w} e-mail: <email>{w}(at){w}(dot)com</email>",
    "{w} {w} <email>{w}.{w}##@mail#.example.com</email> {w}",
    "{W} {w} <email>{w}ö{w}@{w}.de</email> {w}",
    "contact <email>{w}@{w}é.fr</email> {w}",
    "{w} {w} <email>{w}_{w} [AT] {w} [DOT] com</email> {w}",
    "{w} {w} <ip>{v}.{v}.{v}.{v}</ip> {w}",
    "{w} from <ip>{v}[.]{v}[.]{v}[.]{v}</ip> {w} {w}",
    "host <ip>{x}:{x}:{x}:{x}:{x}:{x}:{x}:{x}</ip> {w}",
    "{p} <email>{w}{at}{w}{dot}com</email> {p}",
    "{W} {p} <email>{w}.{w}{at}{w}{dot}org</email>, {p}",
    "{p}{j} <phone>(###) 555-####</phone>{j} {p}",
    "{p}{j} <ip>{v}.{v}.{v}.{v}</ip>{j} {p}",
    "{W} {p} <phone>(###) 555-####</phone> {p}",
    "{W} {p} <ip>{x}::{x}</ip> {p}",
    "{p} <ip>{v}.{v}.{v}.{v}</ip> {p}.",
    "{W} {w} <ip>{x}:{x}::{x}</ip> {w}",
    "address <ip>{x}::{x}:{x}:{x}</ip>, {w}",
    "{w} login from <ip>{v}(.){v}(.){v}(.){v}</ip> {w}",
    "card <card>################</card> {w}",
    "{W} credit card number <card>#### #### #### ####</card> {w}",
    "{w} visa <card>####.####.####.####</card>, {w}",
    "{w} mastercard: <card>####/####/####/####</card> {w}",
    "paid with card <card>####-####-####-####</card> {w}",
]
_UNMARKED = [
    "{w} {w} ################ {w} {w}",
    "{W} {w} {w}, {w} ################.",
    "{w} ######## {w} ##########",
    "order ######## {w} {w}, {w} ###",
    "{w} 20##-0#-## {w} {w}",
    "{W} {w} ##.0#.20## {w}",
    "{w} at 1#:## {w} {w} 1#:##:##",
    "version 2.0 {w} version #.##.#",
    "Licensed under the {W} License, Version 2.0.",
    "Licensed under CC BY-NC 4.0.",
    "{w} #.# {w} #.#.# {w} section #.#.#.",
    "{w} costs $#,###.## {w} ##% {w}",
    "{W} of 19## {w} 20## {w}",
    '{w} token = "{x}{x}{x}{x}{x}{x}{x}{x}{x}{x}" {w}',
    'key = "{x}{x}{x}{x}{x}{x}{x}{x}" {w} {w}',
    "{w} | {w} | ### | {W} | #### | {w}",
    "{w} at the {w} dot {w} {w}",
    "{w} at {w} {w}. {W} {w} {w} {w}.",
    "{w} @ {w} {w} @{w} {w}",
    "{w}!! {w}%%% {w}&&& {w}*** {w}$$$ ###",
    "std::{w} {w}::{w}() {w}[#] = {w}[##];",
    "{w}(#) + {w}(##) = #### {w}",
    "chapter ## page ### line ####",
    "{w} isbn ###-#-##-######-# {w}",
    "{w} ####-#### {w} ### - ### {w}",
    "http://{w}.{w}.com/{w}/####?{w}=##",
    "{w} {v}.{v}.{v} {w} {v}.{v}",
    "{W} {w} {w} {w} {w} {w}, {w} {w}.",
    "{w} phone {w} {w} card {w} mail {w}.",
    "{W} {p}, {p}.",
    "{W} {p} at the {p} at {p}.",
    "{p} at {w} {p}, {p} at {w}.",
    "{W} {p}\n{p}.\n{W} {p}!",
    "{p} | {p} | {p}",
    "{W} {p} dot {p}, {w} com {p}",
    "{w}{j} {w}{j} {w}{j} {w}{j} {w}{j} {w}{j} {W}.{j} {w}{j}",
    "{w}{j} {w}{j} {w},{j} {w}{j} ################{j} {w}{j} {w}{j}",
    "{w}({w}) {w}[{w}] {w}({w}.{w}) {w}[{w}.{w}]",
    "{w} ({w}) {w} [{w}] {p} ({w} {w}) {w}.",
    "{W} {p}, {p} at {p}, {p} and {p}.",
    "{w} : {w} ; {w} - {w} ( {w} ) {w} # {w}",
    "{w} ### {w} ## {w} # {w}",
    "{w} ######, {w} ####### {w} #########",
]
# Common words of four languages, among them those of spelled-out addresses.
_COMMON = (
    "the and of to in is was at on for with that this by an are from it dot com "
    "der die und das zu ist von mit ein le la et les de un que est el los y en a"
).split()
_SYLLABLES = (
    "an be co da el fi go ha in jo ke le mi nu or pa qui re so ti un vé wa ex zu th er ing "
    "the and est ion heit lich ción ñor çai ße"
).split()
_MARK = re.compile(r"<(/?)(email|ip|card|phone)>")


def _filled(template: str, chance: random.Random) -> str:
    def word() -> str:
        return "".join(chance.choices(_SYLLABLES, k=chance.randint(2, 4)))

    def prose() -> str:
        words = [chance.choice(_COMMON) if chance.random() < 0.4 else word() for _ in range(12)]
        return " ".join(words[: chance.randint(2, 12)])

    parts = {
        "{w}": word,
        "{p}": prose,
        "{j}": lambda: chance.choice("!#$%&*~") * chance.randint(1, 3),
        "{at}": lambda: chance.choice(["(at)", "[at]", " (at) ", " [at] ", "@", " [@] "]),
        "{dot}": lambda: chance.choice(["(dot)", "[dot]", " (dot) ", " [dot] ", ".", "[.]"]),
        "{W}": lambda: word().capitalize(),
        "{v}": lambda: str(chance.randint(0, 255)),
        "{x}": lambda: f"{chance.randrange(1 << 16):04x}",
        "#": lambda: str(chance.randrange(10)),
    }
    return re.sub(r"\{\w+\}|#", lambda m: parts[m.group()](), template)


def unmarked(marked: str) -> tuple[str, list[tuple[str, int, int]]]:
    """A text without its marks, and the spans that they enclosed."""
    text, spans, opened, last = "", [], 0, 0
    for m in _MARK.finditer(marked):
        text += marked[last : m.start()]
        last = m.end()
        if m.group(1):
            spans.append((m.group(2), opened, len(text)))
        else:
            opened = len(text)
    return text + marked[last:], spans


def _with_check_digit(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with the last digit of each card number made right."""
    for kind, start, end in spans:
        if kind == "card":
            ways = (f"{text[start:end - 1]}{d}" for d in range(10))
            right = next(w for w in ways if luhn("".join(filter(str.isdecimal, w))))
            text = text[:start] + right + text[end:]
    return text


def labelled_table(spark: SparkSession, rows: int = EXAMPLES, seed: int = 7) -> DataFrame:
    """The table the field is trained from unless another is given: (text, spans)."""
    chance = random.Random(seed)
    templates = _MARKED + _UNMARKED
    made = [unmarked(_filled(templates[k % len(templates)], chance)) for k in range(rows)]
    made = [(_with_check_digit(text, spans), spans) for text, spans in made]
    return spark.createDataFrame(made, f"text string, spans {SPANS}")


def train_field(labelled: DataFrame, limit: int = MAX_EXAMPLES) -> crf.Crf:
    """A field from a labelled table (text, spans).

    Rows without a text are passed over; of a table of more than `limit` rows those that
    come first by the hash of their text are taken. The same table gives the same field.
    """
    rows = (
        labelled.where("text IS NOT NULL")
        .orderBy(F.xxhash64("text"), "text", F.to_json("spans"))
        .limit(limit)
        .select("text", "spans")
        .collect()
    )
    if not rows:
        return crf.Crf(["O", *[f"{p}-{k}" for k in KINDS for p in "BI"]], np.empty(0, np.uint64))
    spans = [[(s["kind"], s["start"], s["end"]) for s in r["spans"] or []] for r in rows]
    return crf.train([r["text"] for r in rows], spans, KINDS)


# A piece of a long text ends after a line end, where a unit ends too.
def _pieces(text: str) -> Iterator[tuple[int, str]]:
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > PIECE:
            cut = text.find("\n", start + PIECE)
            end = cut + 1 if cut >= 0 else end
        yield start, text[start:end]
        start = end


def field_spans(field: crf.Crf, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """What the field finds in each text, whatever the patterns find."""
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    group: list[tuple[int, int, int, str]] = []
    held = 0

    def work() -> None:
        # Texts are parted by a line end, which also ends a unit.
        whole = crf.code_points("\n".join(piece for *_, piece in group))
        tokens = crf.tokens_of(whole)
        spans = iter(crf.spans_of(field, tokens, field.decode(tokens)))
        span = next(spans, None)
        for number, offset, place, piece in group:
            while span and span[1] < place + len(piece):
                kind, a, b = span
                if plausible(kind, piece[a - place : b - place]):
                    found[number].append((kind, a - place + offset, b - place + offset))
                span = next(spans, None)

    for number, text in enumerate(texts):
        for offset, piece in _pieces(text):
            group.append((number, offset, held, piece))
            held += len(piece) + 1
            if held >= GROUP:
                work()
                group, held = [], 0
    if group:
        work()
    return found


# Forms that a span of the field must have besides its labels: an @ or its bracketed name in
# an address, the digits of a number, the parts of an IP address; and its greatest length.
_AT = re.compile(r"@|[(\[{] ?(?:at|AT|@) ?[)\]}]")
_V6 = re.compile(r"[0-9A-Fa-f:]+")
_V4 = re.compile(r"[0-9]{1,3}(?:[^0-9A-Za-z]+[0-9]{1,3}){3}")
_LENGTH = {"email": 254, "ip": 45, "card": 40, "phone": 30}


def plausible(kind: str, found: str) -> bool:
    """Whether a span that the field has marked can be of its kind at all."""
    if len(found) > _LENGTH[kind] or "\n" in found:
        return False
    digits = sum("0" <= c <= "9" for c in found)
    if kind == "email":
        at = _AT.search(found)
        return bool(at and 0 < at.start() and at.end() < len(found))
    if kind == "ip":
        return bool(_V4.fullmatch(found) or (found.count(":") >= 2 and _V6.fullmatch(found)))
    if kind == "card":
        return 14 <= digits <= 19 and luhn("".join(c for c in found if "0" <= c <= "9"))
    return 7 <= digits <= 15


def _apart(span: tuple[str, int, int], base: list[tuple[str, int, int]]) -> bool:
    return all(span[2] <= a or b <= span[1] for _, a, b in base)


def personal_data(docs: DataFrame, field: crf.Crf) -> DataFrame:
    """(doc_id, patterns, spans) of each row of `docs`.

    `patterns` are the spans (kind, start, end) that the fixed patterns find, `spans` those
    and the ones the field adds, both by start, then kind; places count code points, ends
    are exclusive. Null and empty texts have none; repeated rows and null ids stay rows of
    their own; no rows give none; extra columns are left out. Rows do not meet, so nothing
    is shuffled; the field is some megabytes and goes to each task.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(field)
    fields = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
    span_type = pa.list_(pa.struct(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in texts_of(batch)]
            base = [pattern_spans(text) for text in texts]
            every = [
                in_order(b + [s for s in more if _apart(s, b)]) if more else b
                for b, more in zip(base, field_spans(sent.value, texts), strict=True)
            ]
            columns = [
                pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in row] for row in rows], span_type)
                for rows in (base, every)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", "patterns", "spans"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, patterns {SPANS}, spans {SPANS}"
    )


def span_text(spans: Column) -> Column:
    """The spans as kind:start:end, joined by commas."""
    one = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(one, ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets.

    Where spans overlap, the part of a later one that an earlier one covers is gone already.
    """
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("bigint").alias("done"))
    merged = F.aggregate(
        spans,
        start,
        lambda state, s: F.struct(
            F.concat(
                state["text"],
                F.when(
                    s["start"] >= state["done"],
                    F.concat(
                        F.substring(text, state["done"] + 1, s["start"] - state["done"]),
                        F.lit("<"), s["kind"], F.lit(">"),
                    ),
                ).otherwise(F.lit("")),
            ).alias("text"),
            F.greatest(s["end"], state["done"]).alias("done"),
        ),
    )
    rest = F.substring(text, merged["done"] + 1, F.length(text))
    return F.concat(merged["text"], rest)
