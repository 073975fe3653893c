r"""Conversation structure repair: the cheapest edits after which the roles read ``(s?(ua)+)?``.

Each row is kept (0), given the role user or assistant (1) or deleted (2, a must for blank rows and
duplicates); rows with empty text may be inserted anywhere (5); a truncated row that stays costs 5 more. An
audit is the edits' initials in order; of equally cheap ones the least by ASCII is taken.

1. Rows are dealt in ranges of (conv_id, turn, role, text) and written with their place, so a conversation of
   any size is spread over tasks. First places of each (conversation, role, text) are aggregated and joined by
   place, so a text that is often repeated is no hot key.
2. A row becomes one symbol: the class of its role and its fault. Symbols are gathered in pieces of at most
   ``PIECE`` rows, then per conversation.
3. Per conversation a dynamic program runs over the symbols. Audits of partial solutions are nodes that link to
   the edit before them, so equal prefixes are held once. Each node has binary-lifting ancestors and a rolling
   hash of its whole prefix; a tie is decided at the end of the longest common prefix, which is searched by the
   hashes, and a common prefix of two chains is then compared letter by letter. From time to time the prefix
   that all live solutions share is put out and forgotten.
4. The edits go back to the rows by place.

Only symbols, one byte and one place a row, meet in the task of a conversation; its texts do not.

Defined cases: a null role or text is one space; rows of null conv_id are one conversation; rows are ordered by
turn (null first), then role, then text; equal rows are all counted, all but the first as duplicates (or blank); an
empty table gives no rows; other columns are not looked at. Role classes are by first letter, case counts.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wayfold.llm.common import kept, small_batches

SPACE = r"[\x20\x09-\x0D]"
PIECE = 12  # bits of a place within a piece
#: Symbols by role class (user, assistant, system, other) and fault (none, truncated, to be deleted).
SYMBOLS = "uU0aA1sS2xX3"
START, AFTER_S, AFTER_U, AFTER_A = range(4)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: What one state can cost at most beyond another and still win: two inserts, and a system row deleted after all.
REACH = 2 * INSERT + DELETE
MODULUS, BASE = (1 << 61) - 1, 1_000_003
NODES = 1 << 16  # nodes held before the shared prefix is put out


class Prefixes:
    """Audit prefixes as linked nodes; node 0 is the empty one."""

    def __init__(self, modulus: int = MODULUS) -> None:
        self.modulus = modulus
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[tuple[int, ...]] = [()]

    def add(self, node: int, letter: str) -> int:
        ups, k = [node], 0
        while k < len(self.up[ups[k]]):
            ups.append(self.up[ups[k]][k])
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % self.modulus)
        self.up.append(tuple(ups))
        return len(self.letter) - 1

    def above(self, node: int, depth: int) -> int:
        while (more := self.depth[node] - depth) > 0:
            node = self.up[node][more.bit_length() - 1]
        return node

    def word(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def difference(self, a: int, b: int) -> tuple[int, int] | None:
        """Of two nodes of one depth, the first nodes from the root whose letters differ; None if the words are equal."""
        found = None
        while a != b:
            if self.letter[a] != self.letter[b]:
                found = a, b
            a, b = self.up[a][0], self.up[b][0]
        return found

    def less(self, x: int, y: int) -> bool:
        """Whether the word of x comes before that of y."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self.above(x, depth), self.above(y, depth)
        if self.hash[a] != self.hash[b]:
            for k in reversed(range(len(self.up[a]))):
                if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                    a, b = self.up[a][k], self.up[b][k]
            place = self.difference(self.up[a][0], self.up[b][0]) or (a, b)  # equal hashes are no proof
        else:
            place = self.difference(a, b)
        if place is None:
            return self.depth[x] < self.depth[y]
        return self.letter[place[0]] < self.letter[place[1]]


class Repair:
    """The dynamic program over one conversation's symbols, fed in order."""

    def __init__(self, nodes: int = NODES, modulus: int = MODULUS) -> None:
        self.modulus, self.limit, self.least = modulus, nodes, nodes
        self.paths = Prefixes(modulus)
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}
        self.settled: list[str] = []
        self._inserts(self.best)

    def _offer(self, best: dict[int, tuple[int, int]], state: int, cost: int, node: int, letter: str) -> None:
        if state in best and best[state][0] < cost:
            return
        made = self.paths.add(node, letter)
        if state not in best or cost < best[state][0] or self.paths.less(made, best[state][1]):
            best[state] = cost, made

    def _inserts(self, best: dict[int, tuple[int, int]]) -> None:
        for state in (START, AFTER_S, AFTER_A):
            if state in best:
                self._offer(best, AFTER_U, best[state][0] + INSERT, best[state][1], "I")
        if AFTER_U in best:
            self._offer(best, AFTER_A, best[AFTER_U][0] + INSERT, best[AFTER_U][1], "I")

    def feed(self, symbols: str) -> None:
        for symbol in symbols:
            role, fault = divmod(SYMBOLS.index(symbol), 3)
            best: dict[int, tuple[int, int]] = {}
            more = CUT * (fault == 1)
            for state, (cost, node) in self.best.items():
                self._offer(best, state, cost + DELETE, node, "D")
                if fault == 2:
                    continue
                wanted, after = (1, AFTER_A) if state == AFTER_U else (0, AFTER_U)
                if role == wanted:
                    self._offer(best, after, cost + more + KEEP, node, "K")
                else:
                    self._offer(best, after, cost + more + REROLE, node, "R")
                if role == 2 and state == START:
                    self._offer(best, AFTER_S, cost + more + KEEP, node, "K")
            self._inserts(best)
            most = min(c for c, _ in best.values()) + REACH
            self.best = {s: b for s, b in best.items() if b[0] <= most}
            if len(self.paths.letter) > self.limit:
                self._settle()

    def _settle(self) -> None:
        """Puts out the prefix that all live solutions share, and keeps only their nodes."""
        words = {s: self.paths.word(n) for s, (_, n) in self.best.items()}
        shared = len(os.path.commonprefix(list(words.values())))
        self.settled.append(next(iter(words.values()))[:shared])
        self.paths, made = Prefixes(self.modulus), {}
        for state, word in words.items():
            node = 0
            for letter in word[shared:]:
                if (node, letter) not in made:
                    made[node, letter] = self.paths.add(node, letter)
                node = made[node, letter]
            self.best[state] = self.best[state][0], node
        self.limit = max(self.least, 2 * len(self.paths.letter))

    def result(self) -> tuple[int, str]:
        ends = [self.best[s] for s in (START, AFTER_A) if s in self.best]
        cost, node = ends[0]
        for c, n in ends[1:]:
            if c < cost or (c == cost and self.paths.less(n, node)):
                cost, node = c, n
        return cost, "".join(self.settled) + self.paths.word(node)


def edits_by_row(audit: str, symbols: Iterator[str]) -> list[str]:
    """What each row becomes: ``K`` as it is, ``U`` or ``A`` with that role, ``D`` nothing; ``u`` and ``a`` before
    it (after it, at the end) are inserted rows."""
    out, state, before = [], START, ""
    for letter in audit:
        if letter == "D":
            next(symbols)
            out.append(before + "D")
            before = ""
            continue
        role = "x" if letter == "I" else SYMBOLS[SYMBOLS.index(next(symbols)) // 3 * 3]
        if letter == "K" and role == "s":
            state = AFTER_S
            out.append(before + "K")
            before = ""
            continue
        state = AFTER_A if state == AFTER_U else AFTER_U
        now = "ua"[state == AFTER_A]
        if letter == "I":
            before += now
        else:
            out.append(before + ("K" if letter == "K" else now.upper()))
            before = ""
    if out:
        out[-1] += before
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its
    text, 2 takes its end marks, 3 repeats it, 4 makes it a user's."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), F.concat(name("conv_id"), F.lit(":"), name("turn")).alias("key"))
    rows = rows.withColumn("kind", F.crc32(F.col("key").cast("binary")) % 20).where("kind <> 0")
    kind, text = F.col("kind"), F.col("text")
    rows = rows.withColumn("text", F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text))
    rows = rows.withColumn("role", F.when(kind == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))).select("conv_id", "turn", "role", "text")


def fault(text: Column, seen: Column) -> Column:
    """blank, duplicate, truncated or null: the first that holds."""
    return (
        F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "blank").when(seen, "duplicate")
        .when(~text.rlike(rf"[.!?]{SPACE}*\z"), "truncated")
    )


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired rows and the audits.

    Rows: (conv_id, place, turn, role, text, fault, edit, made): every row of the input in its place, and what it became as
    an array of {role, text}, inserted rows included. Audits: one row per conversation, (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit)."""
    spark = conversations.sparkSession
    small_batches(spark)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select("conv_id", "turn", name("role"), name("text"), F.monotonically_increasing_id().alias("dealt"))
    order = ["conv_id", "turn", "role", "text", "dealt"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("dealt")
    ordered = kept(ordered.withColumn("place", F.monotonically_increasing_id()), "conversations")
    short = ordered.select("conv_id", "turn", "place", "role", "text", F.md5("text").alias("digest"))
    first = short.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(False).alias("again"))
    marked = short.select("conv_id", "turn", "place", F.substring("role", 1, 1).alias("initial"), fault(F.col("text"), F.lit(False)).alias("fault"))
    seen = F.coalesce("again", F.lit(True))
    marked = marked.join(first, "place", "left").withColumn("fault", F.when((F.col("fault") == "blank") | ~seen, F.col("fault")).when(seen, "duplicate"))
    role = F.coalesce(F.array_position(F.array(*map(F.lit, "uas")), F.col("initial")), F.lit(0))
    role = F.when(role == 0, 3).otherwise(role - 1)
    bad = F.when(F.col("fault").isNull(), 0).when(F.col("fault") == "truncated", 1).otherwise(2)
    marked = marked.withColumn("symbol", F.substring(F.lit(SYMBOLS), (role * 3 + bad + 1).cast("int"), F.lit(1)))
    marked = kept(marked.select("conv_id", "turn", "place", "fault", "symbol"), "symbols")

    piece = F.array_sort(F.collect_list(F.struct("place", "symbol"))).alias("rows")
    pieces = marked.groupBy("conv_id", F.shiftright("place", PIECE).alias("piece")).agg(piece)
    pieces = pieces.select("conv_id", F.struct("piece", F.col("rows.place").alias("places"), F.array_join("rows.symbol", "").alias("symbols")).alias("piece"))
    # Symbols are few bytes for the time they take: dealt to a fixed number of tasks, which adaptive execution leaves as it is.
    pieces = pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id")
    whole = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    kind = whole.schema["conv_id"].dataType.simpleString()
    solved = kept(whole.mapInArrow(_solve, f"conv_id {kind}, cost bigint, illegal bigint, audit string, places array<bigint>, edits array<string>"), "audits")

    edits = solved.where("places IS NOT NULL").select(F.explode(F.arrays_zip("places", "edits")).alias("e")).select("e.places", "e.edits")
    edits = edits.select(F.col("places").alias("place"), F.col("edits").alias("edit")).join(marked.select("place", "fault"), "place")
    done = ordered.join(edits, "place").withColumn("made", _made())
    count = lambda f: F.count_if(F.col("fault") == f).cast("bigint").alias(f)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps")
    counts = marked.groupBy("conv_id").agg(gaps, count("blank"), count("duplicate"), count("truncated"))
    audits = solved.where("places IS NULL").select(F.col("conv_id").alias("id"), "illegal", "cost", "audit")
    audits = counts.join(audits, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
    return done.select("conv_id", "place", "turn", "role", "text", "fault", "edit", "made"), audits


def _made() -> Column:
    """The array of {role, text} that a row became."""
    row = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    user, assistant, none = F.lit("user"), F.lit("assistant"), F.lit("")

    def one(letter: Column) -> Column:
        return (
            F.when(letter == "K", row(F.col("role"), F.col("text"))).when(letter == "U", row(user, F.col("text"))).when(letter == "A", row(assistant, F.col("text")))
            .when(letter == "u", row(user, none)).when(letter == "a", row(assistant, none))
        )

    return F.transform(F.filter(F.split("edit", ""), lambda c: (c != "") & (c != "D")), one)


LEGAL = {"su", "ua", "au"}


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation a row with cost, illegal and audit, and a row per piece with the edits of its places."""
    names = ["conv_id", "cost", "illegal", "audit", "places", "edits"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string())]
    for batch in batches:
        for at in range(len(batch)):
            pieces = batch.column(1)[at].as_py()
            program, illegal, before = Repair(), 0, ""
            for p in pieces:
                program.feed(p["symbols"])
                roles = before + "".join(SYMBOLS[SYMBOLS.index(c) // 3 * 3] for c in p["symbols"])
                illegal += sum(a + b not in LEGAL for a, b in zip(roles, roles[1:], strict=False))
                before = roles[-1]
            cost, audit = program.result()
            edits = edits_by_row(audit, (c for p in pieces for c in p["symbols"]))
            rows, done = [(cost, illegal, audit, None, None)], 0
            for p in pieces:
                rows.append((None, None, None, p["places"], edits[done : done + len(p["places"])]))
                done += len(p["places"])
            ids = batch.column(0).slice(at, 1).take(pa.array([0] * len(rows)))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([ids, *columns], names)


def repaired_digests(conversations: DataFrame) -> DataFrame:
    """The contract's row per conversation of the table, after ``damage``: the audit and the digest of the repaired
    ``role:text`` lines."""
    rows, audits = repair(damage(conversations))
    lines = F.array_join(F.transform("made", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    lines = rows.where(F.size("made") > 0).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", lines.alias("line")))).alias("lines"))
    lines = lines.select(F.col("conv_id").alias("line_id"), F.sha2(F.array_join("lines.line", "\n"), 256).alias("sha"))
    every = conversations.select(F.col("conv_id").alias("every_id")).distinct()
    out = every.join(audits, F.col("every_id").eqNullSafe(F.col("conv_id")), "left").join(lines, F.col("every_id").eqNullSafe(F.col("line_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        F.col("every_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
