"""Conversation structure repair: Wagner-Fischer alignment to an alternating grammar.

Turns are aligned to the role strings of ``(s?(ua)+)?``: nothing, or user and assistant
in turn, perhaps after a system turn. Edits: Keep (0), Rerole to user or assistant (2),
Delete (3), Insert an empty user or assistant turn (2); a truncated turn that stays adds
1. Blank and repeated turns must go. The answer is the cheapest list of edits, of
equally cheap ones the one whose initials come first in ASCII.

Each feasible length of the target is aligned by itself, those next to the number of
turns first. The cheapest cost so far (at first that of deleting all) is the incumbent:
targets that differ in length by more than it pays for are left out, and within a
target only the cells of Ukkonen's band are filled, those that the incumbent can reach
and leave. Targets of equal cost are told apart by their audits, read back from the table.

Rows go by conversation to the tasks, sorted, and stream through: a task holds the
texts of one conversation, and those only up to ``HELD_BYTES`` and ``ALIGNED_TURNS``
turns. The number of cells grows with the cube of a conversation's turns, so longer
conversations (a third of all rows may be one) take an exact way of their own: one pass
over the turns backwards with the cheapest cost from each of the grammar's four states,
one forwards that takes the first letter on a cheapest path. Their texts are not held:
a second stream brings the letters before the turns and feeds the digest. What a task
keeps then is about 130 bytes a turn, and one task has to see all turns of a
conversation, as the digest of its text is one chain.

Defined results: a null conversation id is one conversation; null roles and texts are
one space; null turns come first; turns of equal number go by role, then text. A role
counts by its first letter; an empty role can't be kept. Conversations without turns
have zeros, an empty audit and the digest of the empty string. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FULL_ROLE = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
# Conversations beyond these take the linear way; their texts are streamed a second time.
ALIGNED_TURNS, HELD_BYTES = 64, 16 << 20
FAR = 1 << 40


def alignment(codes: str, target: str, most: int) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits that turn the codes into the target, if not above ``most``.

    A code is an initial (s, u, a or another letter) in lower case, in upper case if the
    turn is truncated, or ``-`` for a turn that must go.
    """
    n, size = len(codes), len(target)

    def bound(deleted: int) -> int:
        """What a surplus of deletions (or of insertions, if negative) costs at least."""
        return DELETE * deleted if deleted > 0 else -INSERT * deleted

    # suffix[i][j]: the least cost of turning the turns from i into the target from j.
    suffix = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, below = suffix[i], suffix[i + 1] if i < n else {}
        low = max(0, i - most // DELETE)
        for j in range(min(size, i + most // INSERT), low - 1, -1):
            if bound(i - j) + bound((n - i) - (size - j)) > most:
                continue
            best = 0 if i == n and j == size else FAR
            if i < n:
                best = min(best, DELETE + below.get(j, FAR))
                if j < size:
                    best = min(best, _placed(codes[i], target[j])[0] + below.get(j + 1, FAR))
            if j < size and target[j] != "s":
                best = min(best, INSERT + row.get(j + 1, FAR))
            if best <= most:
                row[j] = best
    if 0 not in suffix[0]:
        return None
    i = j = 0
    audit = []
    while i < n or j < size:
        left = suffix[i][j]
        if i < n and DELETE + suffix[i + 1].get(j, FAR) == left:
            audit.append("D")
            i += 1
        elif j < size and target[j] != "s" and INSERT + suffix[i].get(j + 1, FAR) == left:
            audit.append("I")
            j += 1
        else:
            audit.append(_placed(codes[i], target[j])[1])
            i, j = i + 1, j + 1
    return suffix[0][0], "".join(audit)


def _placed(code: str, wanted: str) -> tuple[int, str]:
    """(cost, letter) of having a turn stand for a role of the target."""
    if code == "-":
        return FAR, ""
    extra = TRUNCATED if code.isupper() else 0
    if code.lower() == wanted:
        return KEEP + extra, "K"
    return (REROLE + extra, "R") if wanted != "s" else (FAR, "")


def aligned(codes: str) -> tuple[int, str]:
    """(cost, audit) over all feasible targets."""
    n = len(codes)
    cost, audit = DELETE * n, "D" * n
    lengths = sorted(range(2, n + DELETE * n // INSERT + 2), key=lambda size: (abs(size - n), size))
    for size in lengths:
        if (INSERT * (size - n) if size > n else DELETE * (n - size)) > cost:
            continue
        target = "ua" * (size // 2)
        found = alignment(codes, "s" + target if size % 2 else target, cost)
        if found is not None:
            cost, audit = min((cost, audit), found)
    return cost, audit


# The states of the grammar: nothing yet, after a system turn, after a user turn, after an assistant turn.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (True, False, False, True)
BLOCK = 4096


def _before(code: str | None, after: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs from each state before a turn (None: at the end), from those after it."""
    if code is None:
        cost = [0 if end else FAR for end in ENDS]
    else:
        cost = [DELETE + after[q] for q in range(4)]
        for q, steps in enumerate(STEPS):
            for wanted, then in steps.items():
                cost[q] = min(cost[q], _placed(code, wanted)[0] + after[then])
    # Insertions before the turn: at most two help, as a pair leads back.
    for _ in range(2):
        cost = [min(c, *(INSERT + cost[then] for wanted, then in STEPS[q].items() if wanted != "s"))
                for q, c in enumerate(cost)]
    return tuple(min(c, FAR) for c in cost)


def walked(codes: str) -> tuple[int, str]:
    """The same as ``aligned``, in time proportional to the number of turns."""
    n = len(codes)
    # Costs are kept at every block's end and found again block by block.
    ends = {}
    here = _before(None, ())
    for i in range(n, -1, -1):
        if i < n:
            here = _before(codes[i], here)
        if i % BLOCK == 0 or i == n:
            ends[i] = here
    cost, state, i, audit = ends[0][0], 0, 0, []
    for start in range(0, n + 1, BLOCK):
        stop = min(n, start + BLOCK)
        rows = [ends[stop]]
        for k in range(stop - 1, start - 1, -1):
            rows.append(_before(codes[k], rows[-1]))
        rows.reverse()
        while i < stop or (i == n and stop == n):
            left = rows[i - start][state]
            if i < n and DELETE + rows[i - start + 1][state] == left:
                audit.append("D")
                i += 1
                continue
            if i == n and ENDS[state] and left == 0:
                return cost, "".join(audit)
            step = next((t for w, t in STEPS[state].items() if w != "s" and INSERT + rows[i - start][t] == left), None)
            if step is not None:
                audit.append("I")
                state = step
                continue
            letter, state = min(
                (_placed(codes[i], w)[1], t) for w, t in STEPS[state].items()
                if _placed(codes[i], w)[0] + rows[i - start + 1][t] == left)
            audit.append(letter)
            i += 1
    return cost, "".join(audit)


def damaged(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, gone: the rows with the damage done; a dropped row stays as a mark (gone)."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col(conv_id).cast("string"), blank), F.lit(":"),
                    F.coalesce(F.col(turn).cast("string"), blank))
    kind = F.crc32(F.encode(name, "utf-8")) % 20
    rows = turns.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, blank).alias("role"),
        F.coalesce(text, blank).alias("text"), kind.alias("kind"))
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


class Conversation:
    """The turns of one conversation as they come, in order."""

    def __init__(self, key, aligned_turns: int, held_bytes: int) -> None:
        self.key, self.most, self.bytes = key, aligned_turns, held_bytes
        self.codes, self.seen, self.texts = [], set(), []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.last = None
        self.distinct = 0
        self.before = None

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.last
            self.high = self.last = turn
        initial = role[:1]
        if self.before is not None:
            self.counts["illegal"] += self.before + initial not in LEGAL
        self.before = initial
        own = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        shown = text.rstrip(BLANK)
        code = initial if initial in ("s", "u", "a") else "x"
        if not shown:
            self.counts["blank"] += 1
            code = "-"
        elif own in self.seen:
            self.counts["duplicate"] += 1
            code = "-"
        elif shown[-1] not in ".!?":
            self.counts["truncated"] += 1
            code = code.upper()
        self.seen.add(own)
        self.codes.append(code)
        if self.texts is not None:
            self.texts.append((role, text))
            self.bytes -= len(role) + len(text)
            if len(self.codes) > self.most or self.bytes < 0:
                self.texts = None

    def result(self, known: dict) -> dict:
        codes = "".join(self.codes)
        if len(codes) > self.most:
            cost, audit = walked(codes)
        else:
            if codes not in known:
                if len(known) > 100_000:
                    known.clear()
                known[codes] = aligned(codes)
            cost, audit = known[codes]
        sha = None
        if self.texts is not None:
            repaired = Repaired(audit)
            for role, text in self.texts:
                repaired.add(role, text)
            sha = repaired.digest()
        gaps = self.high - self.low + 1 - self.distinct if self.low is not None else 0
        return {"conv": self.key, "gaps": gaps, **self.counts, "cost": cost, "audit": audit, "sha": sha}


class Repaired:
    """The digest of a conversation's repaired text, turn by turn."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.next = audit, 0, "u"
        self.sha, self.first = hashlib.sha256(), True

    def _line(self, role: str, text: str) -> None:
        self.sha.update((("" if self.first else "\n") + f"{role}:{text}").encode())
        self.first = False
        self.next = "a" if role[:1] == "u" else "u"

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._line(FULL_ROLE[self.next], "")

    def add(self, role: str, text: str) -> None:
        self._insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._line(role if edit == "K" else FULL_ROLE[self.next], text)

    def digest(self) -> str:
        self._insertions()
        return self.sha.hexdigest()


def repaired(
    rows: DataFrame, aligned_turns: int = ALIGNED_TURNS, held_bytes: int = HELD_BYTES
) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    rows: conv, turn, role, text and gone (the row only tells that the conversation is there).
    """
    kind = rows.schema["conv"].dataType.simpleString()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = f"conv {kind}, " + ", ".join(f"{n} bigint" for n in names) + ", audit string, sha string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, str]] = {}
        own, out, shape = None, [], None
        for batch in batches:
            shape = batch.schema.field("conv").type
            for conv, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own.key != conv:
                    if own is not None:
                        out.append(own.result(known))
                    own = Conversation(conv, aligned_turns, held_bytes)
                if not gone:
                    own.add(turn, role, text)
            if len(out) > 1000:
                yield _batch(out, shape, names)
                out = []
        if own is not None:
            out.append(own.result(known))
        if out:
            yield _batch(out, shape, names)

    rows = rows.select("conv", "turn", "role", "text", "gone")
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    found = staged(
        rows.repartition("conv").sortWithinPartitions(*order).mapInArrow(run, schema), "conversations")
    return _with_digests(found, rows).withColumnRenamed("sha", "repaired_sha256")


def _batch(out: list[dict], shape: pa.DataType, names: tuple[str, ...]) -> pa.RecordBatch:
    fields = [("conv", shape), *((n, pa.int64()) for n in names), ("audit", pa.string()), ("sha", pa.string())]
    return pa.RecordBatch.from_pylist(out, schema=pa.schema(fields))


def _with_digests(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Fill in the digests of conversations whose texts were not held: letters first, then the turns."""
    long = found.where("sha is null").select(F.col("conv").alias("_conv"), F.col("audit"))
    if long.isEmpty():
        return found
    turns = rows.where("not gone").join(
        long.select("_conv"), F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
    none = F.lit(None)
    letters = long.select(
        F.col("_conv").alias("conv"), none.cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
        F.col("audit").alias("text"), F.lit(False).alias("mine"))
    every = letters.unionByName(turns.select("conv", "turn", "role", "text", F.lit(True).alias("mine")))
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, key, shape = None, None, None
        for batch in batches:
            shape = batch.schema.field("conv").type
            for conv, _, role, text, mine in zip(*(c.to_pylist() for c in batch.columns)):
                if mine:
                    own.add(role, text)
                    continue
                if own is not None:
                    yield one(key, own, shape)
                own, key = Repaired(text), conv
        if own is not None:
            yield one(key, own, shape)

    def one(key, own: Repaired, shape: pa.DataType) -> pa.RecordBatch:
        fields = pa.schema([("conv", shape), ("sha", pa.string())])
        return pa.RecordBatch.from_pylist([{"conv": key, "sha": own.digest()}], schema=fields)

    order = [F.col("conv").asc_nulls_first(), "mine", F.col("turn").asc_nulls_first(), "role", "text"]
    digests = every.repartition("conv").sortWithinPartitions(*order).mapInArrow(run, f"conv {kind}, sha string")
    digests = digests.select(F.col("conv").alias("_conv"), F.col("sha").alias("_sha"))
    joined = found.join(digests, found["conv"].eqNullSafe(digests["_conv"]), "left")
    return joined.withColumn("sha", F.coalesce("sha", "_sha")).drop("_conv", "_sha")


def damaged_and_repaired(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", **options
) -> DataFrame:
    """One row per conversation of the table, after the damage."""
    return repaired(damaged(turns, conv_id, turn, role, text), **options).withColumnRenamed("conv", conv_id)


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0::BIGINT for z in range(8)]), lambda x, z : {step})"
    codes = f"list_transform(string_split({text}, ''), lambda d : CAST(ascii(d) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b : {byte}), 4294967295)"


def repair_sql(table: str = "conversations") -> str:
    """DuckDB SQL of ``damaged_and_repaired``: the grammar's states folded over the turns."""

    def add(state: str, cost: str, letter: str) -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || {letter}}}"

    def best(*states: str) -> str:
        return f"list_sort([{', '.join(states)}])[1]"

    def placed(state: int, wanted: str) -> str:
        other = FAR if wanted == "s" else f"{REROLE} + cut"
        cost = f"(CASE WHEN code = '-' THEN {FAR} WHEN lower(code) = '{wanted}' THEN cut ELSE {other} END)"
        cost = cost.replace("code", "x.code").replace("cut", f"(CASE WHEN x.code <> lower(x.code) THEN {TRUNCATED} ELSE 0 END)")
        return add(f"s.f[{state}]", cost, f"CASE WHEN lower(x.code) = '{wanted}' THEN 'K' ELSE 'R' END")

    def into(state: int, *steps: str) -> str:
        return best(add(f"s.f[{state}]", str(DELETE), "'D'"), *steps)

    inserted = ", ".join([
        "s.f[1]", "s.f[2]",
        best("s.f[3]", *[add(f"s.f[{q}]", str(INSERT), "'I'") for q in (1, 2, 4)]),
        best("s.f[4]", add("s.f[3]", str(INSERT), "'I'"))])
    taken = ", ".join([
        into(1), into(2, placed(1, "s")), into(3, *[placed(q, "u") for q in (1, 2, 4)]), into(4, placed(3, "a"))])
    start = "[" + ", ".join(f"{{'c': {c}::BIGINT, 'a': ''}}" for c in (0, FAR, FAR, FAR)) + "]"
    fold = f"""list_reduce(list_prepend({{'f': {start}, 'code': ''}},
        list_transform(codes, lambda d : {{'f': {start}, 'code': d}})),
        lambda s, x : {{'f': CASE WHEN x.code = 'i' THEN [{inserted}] ELSE [{taken}] END, 'code': ''}}).f"""
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    name = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return f"""
        WITH kinds AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            {_crc32_sql(name)} % 20 AS kind FROM {table}),
        rows_ AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind > 0),
        placed AS (SELECT *, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn FROM rows_),
        seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) AS nth,
            rtrim(text, {space}) AS shown,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY rn) || left(role, 1) AS pair FROM placed),
        faults AS (SELECT *, shown = '' AS blank, shown <> '' AND nth > 1 AS duplicate,
            shown <> '' AND nth = 1 AND right(shown, 1) NOT IN ('.', '!', '?') AS truncated FROM seen),
        coded AS (SELECT *, CASE WHEN blank OR duplicate THEN '-' WHEN truncated THEN upper(initial) ELSE initial END AS code
            FROM (SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial
                FROM faults)),
        whole AS (SELECT conv_id, flatten(list(['i', 'i', code] ORDER BY rn)) || ['i', 'i'] AS codes,
            coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
            count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
            count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM coded GROUP BY conv_id),
        ended AS (SELECT * EXCLUDE (codes), {fold} AS f FROM whole),
        found AS (SELECT * EXCLUDE (f), {best("f[1]", "f[4]")} AS one FROM ended),
        letters AS (SELECT conv_id, j, substr(audit, j, 1) AS letter,
            length(replace(substr(audit, 1, j), 'I', '')) AS rn
            FROM (SELECT conv_id, one.a AS audit, unnest(range(1, length(one.a) + 1)) AS j FROM found)),
        stays AS (SELECT l.conv_id, letter, role, text, row_number() OVER (PARTITION BY l.conv_id ORDER BY j) AS o
            FROM letters l LEFT JOIN coded c
            ON c.conv_id IS NOT DISTINCT FROM l.conv_id AND c.rn = l.rn AND letter <> 'I' WHERE letter <> 'D'),
        lines AS (SELECT *, max(CASE WHEN o = 1 AND letter = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END)
            OVER (PARTITION BY conv_id) AS offset_ FROM stays),
        texts AS (SELECT conv_id, string_agg(
            CASE WHEN letter = 'K' THEN role WHEN (o - offset_) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
            || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY o) AS body FROM lines GROUP BY conv_id)
        SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
            CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
            CAST(coalesce(one.c, 0) AS BIGINT) AS cost, coalesce(one.a, '') AS audit,
            sha256(coalesce(body, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM {table}) a
        LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM a.conv_id
        LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM a.conv_id"""
