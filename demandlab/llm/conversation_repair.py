"""Conversation structure repair: grammar-compressed DP over role / fault sequences.

Rows of a conversation are ordered by turn (NULLs first), then by role and the md5
of the text, which settles ties alike on every run. A row's first fault counts:
blank, duplicate (role and text seen earlier) or truncated. The cheapest edits
(keep, rerole, delete, insert) that make the roles read ``(s?(ua)+)?`` are
found by min-plus products of transfer matrices (``turn_grammar``):

1. Each row becomes one letter. Repeats are found by a partly aggregated
   ``min`` for each (conversation, role, md5), no group is gathered.
2. Rows are dealt by ranges of (conversation, turn, role, md5), so a long
   conversation spreads over tasks; each task joins its letters to pieces and the
   pieces make one text of a byte a row for each conversation.
3. Re-Pair: over the distinct texts, rounds of pair counts; the most frequent
   pairs of a round that don't overlap become rules, until none occurs twice or
   ``max_rules`` are made. What isn't replaced stays as it is: the grammar's size
   bounds the work saved, not the rows.
4. Tasks evaluate every rule's matrix once, bottom-up, and each distinct text by
   the symbols left of it; equal conversations share the answer.
5. Damaged rows travel once with their texts, sorted by conversation behind the
   audit, and are hashed as they pass; no conversation is held in memory.

NULL roles and texts count as one space. Defined cases: a NULL conversation id is a
conversation of its own; rows that repeat in all columns are duplicates of each
other; conversations without rows have zeros, an empty audit and the hash of the
empty string. An empty table gives no rows. Only the four columns named are
read; other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.llm.hotjoin import attach
from demandlab.llm.turn_grammar import LETTERS, compressed, matrices, pair_counts, repair
from demandlab.session import scratch_table, ship_package

NOT_BLANK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
ORDER = ["has_turn", "turn", "role", "md5"]
MAX_RULES, PER_ROUND, ROUNDS = 256, 48, 8


def rows_of(chats: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text under fixed names, NULL roles and texts as one space."""
    return chats.select(chats[id_col].alias("conv_id"), chats[turn_col].cast("long").alias("turn"),
                        *[F.coalesce(chats[c].cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])


def damaged(rows: DataFrame) -> DataFrame:
    """Test damage by crc32 of ``conv_id:turn`` (NULL: one space) modulo 20: drop, empty, strip, repeat, set role user."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")])
    kind = F.crc32(key) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    return rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_c")).drop("_c")


def _key(conv: Column) -> Column:
    """NULL ids apart from all others."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("-"))


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.select(_key(F.col("conv_id")).alias("conv"), F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"), "role",
                       F.md5("text").alias("md5"), "text")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lettered(rows: DataFrame) -> DataFrame:
    """conv, the order's columns, fault and letter of every row; texts stay behind."""
    text = F.col("text")
    slim = _written(_ordered(rows).select("conv", *ORDER, F.when(~text.rlike(NOT_BLANK), "blank").when(~text.rlike(ENDED), "truncated").otherwise("fine").alias("fault"))
                    .withColumn("row", F.monotonically_increasing_id()), "turns")
    # equal (role, text): the first by turn stays, of equal turns the one with the least row number
    repeated = _written(slim.groupBy("conv", "role", "md5").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("has_turn", "turn", "row")).alias("lead")).where("n > 1"), "repeats")
    seen = attach(slim, repeated, ["conv", "role", "md5"])
    fault = F.when(F.col("fault") == "blank", "blank").when(F.coalesce(F.col("lead.row") != F.col("row"), F.lit(False)), "duplicate").otherwise(F.col("fault"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    letter = F.when(fault == "fine", role).when(fault == "truncated", F.translate(role, "suax", "1234")).otherwise(F.upper(role))
    return seen.select("conv", *ORDER, "row", fault.alias("fault"), letter.alias("letter"))


def sequences(letters: DataFrame) -> DataFrame:
    """conv, letters: one text for each conversation, gathered in pieces from tasks that hold ranges of rows."""
    # the row number splits even rows that are equal in all of these
    order = ["conv", *ORDER, "row"]
    dealt = letters.select(*order, "letter").repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "letter", F.spark_partition_id().alias("part"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = 0
        for batch in batches:
            conv, letter, part = (batch.column(c).to_pylist() for c in ("conv", "letter", "part"))
            out, start = [], 0
            for i in range(1, len(conv) + 1):
                if i == len(conv) or conv[i] != conv[start]:
                    out.append((conv[start], part[start], piece, "".join(letter[start:i])))
                    start, piece = i, piece + 1
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                                             names=["conv", "part", "piece", "letters"])

    pieces = dealt.mapInArrow(kernel, "conv string, part int, piece long, letters string")
    all_ = F.sort_array(F.collect_list(F.struct("part", "piece", "letters")))
    return pieces.groupBy("conv").agg(F.array_join(F.transform(all_, lambda p: p["letters"]), "").alias("letters"))


def learn_rules(texts: DataFrame, max_rules: int = MAX_RULES, rounds: int = ROUNDS) -> list[str]:
    """Re-Pair over all distinct ``letters``: the most frequent pairs of symbols, in rounds of counts."""
    rules: list[str] = []
    for _ in range(rounds):
        had = list(rules)

        def count(batches: Iterator[pa.RecordBatch], had=had) -> Iterator[pa.RecordBatch]:
            found: dict[str, int] = {}
            for batch in batches:
                for text in batch.column("letters").to_pylist():
                    pair_counts(compressed(text, had), found)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["pair", "n"])

        top = texts.select("letters").mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1") \
            .orderBy(F.desc("n"), "pair").limit(min(PER_ROUND, max_rules - len(rules))).collect()
        heads: set[str] = set()
        tails: set[str] = set()
        for pair in (r.pair for r in top):
            if pair[0] not in tails and pair[1] not in heads:   # else it may overlap one just taken: left to a later round
                rules.append(pair)
                heads.add(pair[0])
                tails.add(pair[1])
        if not top or len(rules) >= max_rules:
            break
    return rules


def solved(texts: DataFrame, rules: list[str]) -> DataFrame:
    """letters, n, cost, audit, illegal for each distinct text."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = matrices(rules)
        for batch in batches:
            texts = batch.column("letters").to_pylist()
            found = [repair(compressed(t, rules), table) for t in texts]
            illegal = [sum(a + b not in ("su", "ua", "au") for a, b in zip(r, r[1:], strict=False)) for r in (t.translate(ROLE) for t in texts)]
            yield pa.RecordBatch.from_arrays([batch.column("letters"), batch.column("n"), pa.array([c for c, _ in found], pa.int64()),
                                              pa.array([a for _, a in found], pa.string()), pa.array(illegal, pa.int64())], names=["letters", "n", "cost", "audit", "illegal"])

    return texts.select("letters", "n").mapInArrow(kernel, "letters string, n long, cost long, audit string, illegal long")


ROLE = str.maketrans(LETTERS, "suax" * 3)


def hashes(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv, repaired_sha256: rows in order behind their conversation's audit, hashed as they pass."""
    head = audits.select("conv", F.lit(0).alias("kind"), F.lit(False).alias("has_turn"), F.lit(0).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("md5"), F.col("audit").alias("text"))
    stream = head.unionByName(_ordered(rows).withColumn("kind", F.lit(1))).repartition("conv").sortWithinPartitions("conv", "kind", *ORDER)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, text = None, None

        def done(out: list) -> None:
            if conv is not None:
                text.rest()
                out.append((conv, text.sha.hexdigest()))

        for batch in batches:
            out: list = []
            for c, kind, role, value in zip(*(batch.column(n).to_pylist() for n in ("conv", "kind", "role", "text")), strict=True):
                if kind == 0:
                    done(out)
                    conv, text = c, Repaired(value)
                else:
                    text.row(role, value)
            yield _pairs(out)
        out = []
        done(out)
        yield _pairs(out)

    return stream.select("conv", "kind", "role", "text").mapInArrow(kernel, "conv string, repaired_sha256 string")


def _pairs(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.string()), pa.array([h for _, h in out], pa.string())], names=["conv", "repaired_sha256"])


class Repaired:
    """The repaired text under way: its hash, the edits to come and the roles they lead to."""

    def __init__(self, audit: str):
        self.sha, self.audit, self.at, self.any = hashlib.sha256(), audit, 0, False
        made = len(audit) - audit.count("D")
        self.turn = -(made % 2)   # an odd number begins with the system's row, then user and assistant take turns

    def _add(self, role: str | None, text: str) -> None:
        name = role if role is not None else "user" if self.turn % 2 == 0 else "assistant"
        self.sha.update(("\n" if self.any else "").encode() + f"{name}:{text}".encode())
        self.any, self.turn = True, self.turn + 1

    def _inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._add(None, "")

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            self._add(role if edit == "K" else None, text)

    def rest(self) -> None:
        self._inserts()


def conversation_repair(chats: DataFrame, rows: DataFrame, max_rules: int = MAX_RULES) -> DataFrame:
    """One row for each conversation of ``chats`` (conv_id), judged and repaired on ``rows`` (conv_id, turn, role, text: a repeatable scan).

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    spark = chats.sparkSession
    ship_package(spark)
    letters = _written(lettered(rows), "letters")
    per = letters.groupBy("conv").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    span = F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count(F.lit(1))
    turns = letters.where("has_turn").select("conv", "turn").distinct().groupBy("conv").agg(F.least(span, F.lit(2**63 - 1)).alias("gaps"))
    seqs = _written(sequences(letters), "sequences")
    texts = _written(seqs.groupBy("letters").agg(F.count(F.lit(1)).alias("n")), "patterns")
    answers = _written(solved(texts, learn_rules(texts, max_rules)), "answers")
    audits = _written(attach(seqs, answers, ["letters"]).select("conv", "cost", "audit", "illegal"), "audits")
    out = chats.select("conv_id").distinct().withColumn("conv", _key(F.col("conv_id")))
    for part in (per, turns, audits, hashes(rows, audits)):
        out = out.join(part, "conv", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
