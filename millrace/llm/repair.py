"""Repair of conversations by error-correcting Earley parsing.

The grammar says which roles may follow each other: nothing at all, or an optional system row and then pairs of a user's
and an assistant's row. Its edit productions let any symbol be kept, given another role, deleted or inserted, each at a
price. Every rule but the empty one begins with the part that is already parsed, so all of the chart's items begin at
the conversation's first row, and a column has a few items however long the conversation is. An item keeps its least
(cost, audit); an audit is the edits' initials in order, and of equally cheap ones the ASCII-least counts. The parse
that reaches the end gives the repair: which rows stay, under which role, and where empty rows are put in.

A conversation is parsed from a symbol a row (role's initial and fault), so texts aren't gathered: they are sent once,
after their conversation's audit, and pass through in order, a batch at a time.

Defined results: a null role, text or conv_id counts as one space in faults and texts; a null turn sorts first; rows of
equal turn keep the order role, text's digest; repeated rows are duplicates; texts of any length are read whole; extra
columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, stash

#: (what is parsed, part it extends, symbol that follows); None: the empty rule.
GRAMMAR = [
    ("nothing", None, None), ("nothing", "nothing", "gone"),
    ("lead", "nothing", "system"), ("lead", "lead", "gone"),
    ("open", "nothing", "user"), ("open", "lead", "user"), ("open", "pairs", "user"), ("open", "open", "gone"),
    ("pairs", "open", "assistant"), ("pairs", "pairs", "gone"),
]
WHOLE = ("nothing", "pairs")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Symbols of rows: the role's initial, or OTHER; upper case if the text is truncated; GONE for a row that must go.
OTHER, GONE = "o", "-"
#: From the cheapest item two insertions and a deletion lead wherever another item can lead, so dearer ones are dropped.
SPAN = 2 * INSERT + DELETE

Best = tuple[int, str]
CHECKED = "conv_id long, row long, place long, role string, text string"


def scans(wanted: str, symbol: str) -> Iterator[Best]:
    """The edit productions by which a row can stand for a symbol of the grammar."""
    if wanted == "gone":
        yield DELETE, "D"
    elif symbol != GONE:
        worse = TRUNCATED if symbol.isupper() else 0
        if symbol.lower() == wanted[0]:
            yield KEEP + worse, "K"
        elif wanted != "system":
            yield REROLE + worse, "R"


def complete(column: dict[str, Best]) -> dict[str, Best]:
    """Insert rows until no item gets better, then drop the items that can't win."""
    agenda = list(column)
    while agenda:
        part = agenda.pop()
        for out, begun, wanted in GRAMMAR:
            if begun == part and wanted in ("user", "assistant"):
                new = (column[part][0] + INSERT, column[part][1] + "I")
                if out not in column or new < column[out]:
                    column[out] = new
                    agenda.append(out)
    least = min(cost for cost, _ in column.values())
    return {part: best for part, best in column.items() if best[0] <= least + SPAN}


@lru_cache(maxsize=10_000)
def parse(symbols: str) -> Best:
    """The least cost, and the ASCII-least of its audits, of making a conversation fit the grammar."""
    column, settled = complete({out: (0, "") for out, begun, _ in GRAMMAR if begun is None}), []
    for k, symbol in enumerate(symbols):
        after: dict[str, Best] = {}
        for out, begun, wanted in GRAMMAR:
            if begun in column:
                cost, audit = column[begun]
                for price, edit in scans(wanted, symbol):
                    after[out] = min(after.get(out, (cost + price, audit + edit)), (cost + price, audit + edit))
        column = complete(after)
        if k % 64 == 63:  # what all items have in common is settled
            same = os.path.commonprefix([audit for _, audit in column.values()])
            settled.append(same)
            column = {part: (cost, audit[len(same) :]) for part, (cost, audit) in column.items()}
    cost, audit = min(column[part] for part in WHOLE if part in column)
    return cost, "".join(settled) + audit


def repaired_roles(audit: str, first: str) -> Iterator[tuple[str, str | None]]:
    """(edit, new role or None) along an audit: what isn't a kept system row takes turns. first: initial of the first row that stays."""
    user, begun = True, False
    for edit in audit:
        if edit == "D":
            yield edit, None
            continue
        if not begun and edit == "K" and first == "s":
            begun = True
            yield edit, None
            continue
        begun = True
        yield edit, None if edit == "K" else "user" if user else "assistant"
        user = not user


# ---- rows and faults


def faults(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls as one space -> also print (of role and text), initial, blank, duplicate, truncated."""
    marked = _said(turns).select(
        "conv_id", "turn", "role", _print(),
        (~F.col("text").rlike(WORD)).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    )
    # keyed by conversation and text, so a long conversation is dealt out
    seen = F.row_number().over(Window.partitionBy("conv_id", "print").orderBy(F.col("turn").asc_nulls_first())) > 1
    marked = marked.withColumn("seen", seen)
    duplicate = F.col("seen") & ~F.col("blank")
    return marked.select("conv_id", "turn", "role", "print", "blank", duplicate.alias("duplicate"), (F.col("cut") & ~F.col("blank") & ~duplicate).alias("truncated"))


def audits(turns: DataFrame) -> DataFrame:
    """A row for each conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, and the initial of the first row that stays."""
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(OTHER)
    symbol = F.when(F.col("blank") | F.col("duplicate"), GONE).when(F.col("truncated"), F.upper(known)).otherwise(known)
    rows = faults(turns).select("*", symbol.alias("symbol"), F.struct("turn", "role", "print", "duplicate", symbol.alias("symbol")).alias("row"))
    count = lambda c: F.count_if(c).alias(c)
    per = rows.groupBy("conv_id").agg(*map(count, ("blank", "duplicate", "truncated")), F.array_sort(F.collect_list("row")).alias("rows"), F.max("turn").alias("high"), F.min("turn").alias("low"))
    numbered = F.size(F.array_distinct(F.filter(F.col("rows")["turn"], lambda t: t.isNotNull())))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - numbered, F.lit(0)).cast("long").alias("gaps")
    initials = F.transform("rows", lambda r: F.substring(r["role"], 1, 1))
    pairs = F.zip_with(F.slice(initials, 1, F.greatest(F.size("rows") - 1, F.lit(0))), F.slice(initials, F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0))), lambda a, b: F.concat(a, b))
    illegal = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long").alias("illegal")
    per = per.select("conv_id", gaps, "blank", "duplicate", "truncated", illegal, F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("symbols"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = batch.column(batch.num_columns - 1).to_pylist()
            best = [parse(s) for s in symbols]
            stays = [next((s.lower() for s, e in zip(text, audit.replace("I", "")) if e != "D"), "") if not audit.lstrip("D").startswith("I") else "" for text, (_, audit) in zip(symbols, best)]
            new = [pa.array([b[0] for b in best], pa.int64()), pa.array([b[1] for b in best], pa.string()), pa.array(stays, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], "cost", "audit", "first"])

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in per.schema.fields if f.name != "symbols"]
    return per.mapInArrow(run, ", ".join([*kept, "cost long", "audit string", "first string"]))


def _print() -> Column:
    """Tells rows of a conversation apart, and orders those of equal turn and role."""
    return F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32).alias("print")


def _said(turns: DataFrame) -> DataFrame:
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))


def repair(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, edit, role, text, in order inside a conversation and a task.

    found: audits(turns), written. Audits and rows meet in the order of one sort, audits first; a task holds one audit
    and one batch of rows.
    """
    rows = _said(turns).select("conv_id", F.lit(True).alias("said"), "turn", "role", _print(), "text")
    plans = found.select("conv_id", F.lit(False).alias("said"), F.lit(None).cast("long").alias("turn"), F.col("first").alias("role"), F.lit("").alias("print"), F.col("audit").alias("text"))
    ordered = plans.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "said", "turn", "role", "print")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, place = iter(()), 0
        names, types = ("conv_id", "place", "edit", "role", "text"), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        for batch in batches:
            out: list[tuple] = []
            for conv_id, is_row, role, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "said", "role", "text"))):
                if is_row:
                    edit, new = next(steps)
                    if edit != "D":
                        out.append((conv_id, place, edit, new or role, text))
                        place += 1
                else:
                    steps, place = _Steps(repaired_roles(text, role)), 0
                # insertions stand before the next row, so they follow the one just met
                for _, new in steps.inserted():
                    out.append((conv_id, place, "I", new, ""))
                    place += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=list(names))

    return ordered.mapInArrow(run, "conv_id long, place long, edit string, role string, text string")


class _Steps:
    """Edits in order, one ahead, so that insertions can be taken where they stand."""

    def __init__(self, edits: Iterator[tuple[str, str | None]]):
        self.edits, self.ahead = edits, next(edits, None)

    def __next__(self) -> tuple[str, str | None]:
        step, self.ahead = self.ahead, next(self.edits, None)
        return step

    def inserted(self) -> Iterator[tuple[str, str | None]]:
        while self.ahead and self.ahead[0] == "I":
            yield next(self)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired rows as role:text lines, taken as they come from `repair`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []
        for batch in batches:
            for conv_id, place, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if place == 0:
                    done += [] if digest is None else [(key, digest.hexdigest())]
                    key, digest = conv_id, hashlib.sha256()
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        done += [] if digest is None else [(key, digest.hexdigest())]
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.string()))], names=["conv_id", "hash"])

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(run, "conv_id long, hash string")


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations damaged row by row by crc32(`conv_id:turn`) % 20, to be repaired again; nulls as one space."""
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    said = turns.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    said = said.withColumn("kind", F.crc32(F.concat(number("conv_id"), F.lit(":"), number("turn")).cast("binary")) % 20)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return said.filter("kind <> 0").select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repaired_digests(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """For each of ids (conv_id): its faults, the cheapest edits and the hash of the repaired conversation."""
    found = stash(audits(turns), "audits")
    hashes = digests(repair(turns, found))
    known = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("i")
    for name, other in (("f", found), ("h", hashes)):
        known = known.join(other.alias(name), F.col("i.conv_id").eqNullSafe(F.col(f"{name}.conv_id")), "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return known.select(F.col("i.conv_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("hash", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
