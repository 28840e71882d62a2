"""Repair of conversation structure by iterative-deepening A*.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``. Edits walk over its turns: Keep (0), Rerole to
user or assistant (3), Delete (4, the only choice for blank and repeated turns) and Insert of an empty user or assistant turn
(3); a truncated turn that stays adds 3. A depth-first search tries edits in ASCII order (D, I, K, R) under a cost bound that
grows to the least cost seen beyond it, so the first accepting path is the cheapest and, of equal costs, the least in ASCII.
Failed states stay in a table with the cost that they need at least, which is what they are cut by when met again. The table
starts from the relaxed problem that forgets how a conversation has to begin and end.

One task reads all turns of a conversation, sorted, as they stream by. It holds the texts of ``HELD_BYTES`` at most; of a
longer conversation it holds a code and a digest per turn only, and the texts go by a second time beside the edits found.
The audit and the digest of a conversation are single values, so the turns of one conversation are read one after another.
"""

import hashlib

import pyarrow as pa
import xxhash

from pyspark.sql import functions as F

from clickmart.session import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
HELD_BYTES = 8 << 20
CACHED = 50_000
SYSTEM, USER, ASSISTANT, OTHER, GONE = range(5)
CUT = 8  # added to the code of a truncated turn that may stay
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
BLANKS = r"\x20\x09-\x0D"

# States: nothing yet, after s, after u, after a. Next role that a user or assistant turn has in a state, and where it leads.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
NEXT = {START: USER, AFTER_SYSTEM: USER, AFTER_USER: ASSISTANT, AFTER_ASSISTANT: USER}
LEADS = {USER: AFTER_USER, ASSISTANT: AFTER_ASSISTANT}
ACCEPTING = (START, AFTER_ASSISTANT)


def _relaxed(codes):
    """Least costs by state of all rests of a conversation, flat by place and state, when any beginning and end will do."""
    n = len(codes)
    least = [0] * (4 * (n + 1))
    begin = user = assistant = 0
    for place in range(n - 1, -1, -1):
        code = codes[place]
        role, cut = code % CUT, TRUNCATED if code >= CUT else 0
        if role == GONE:
            begin, user, assistant = begin + DELETE, user + DELETE, assistant + DELETE
        else:
            as_user = min(DELETE + user, cut + (KEEP if role == USER else REROLE) + assistant)
            as_assistant = min(DELETE + assistant, cut + (KEEP if role == ASSISTANT else REROLE) + user)
            opened = cut + KEEP + user if role == SYSTEM else DELETE + begin
            user, assistant = min(as_user, INSERT + as_assistant), min(as_assistant, INSERT + as_user)
            begin = min(user, opened, DELETE + begin)
        user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
        begin = min(begin, user)
        least[4 * place : 4 * place + 4] = begin, user, assistant, user
    return least


def _edits(codes, place, state):
    """(letter, cost, next place, next state) of the edits that a state allows, in ASCII order."""
    role, more = NEXT[state], place < len(codes)
    code = codes[place] if more else GONE
    if more:
        yield "D", DELETE, place + 1, state
    yield "I", INSERT, place, LEADS[role]
    if code % CUT != GONE:
        cut = TRUNCATED if code >= CUT else 0
        if code % CUT == role:
            yield "K", KEEP + cut, place + 1, LEADS[role]
        elif code % CUT == SYSTEM and state == START:
            yield "K", KEEP + cut, place + 1, AFTER_SYSTEM
        yield "R", REROLE + cut, place + 1, LEADS[role]


def _within(codes, least, bound):
    """The first accepting path of at most ``bound``, or None; ``least`` learns what failed states need."""
    n = len(codes)
    place, state, left = 0, START, bound
    edits, path = [], [(place, state, left, _edits(codes, place, state))]
    while path:
        place, state, left, rest = path[-1]
        for letter, cost, to, then in rest:
            if cost + least[4 * to + then] <= left:
                edits.append(letter)
                if to == n and then in ACCEPTING:
                    return "".join(edits)
                path.append((to, then, left - cost, _edits(codes, to, then)))
                break
        else:
            least[4 * place + state] = min(cost + least[4 * to + then] for _, cost, to, then in _edits(codes, place, state))
            path.pop()
            del edits[-1:]
    return None


def search(codes):
    """(cost, audit) of the cheapest edits of a conversation given as one code per turn, ties to the least audit in ASCII."""
    if not codes:
        return 0, ""
    least = _relaxed(codes)
    while True:
        bound = least[START]
        audit = _within(codes, least, bound)
        if audit is not None:
            return bound, audit


class Searches(dict):
    """Results of ``search``; those of the first ``CACHED`` short conversations are kept."""

    def __missing__(self, codes):
        found = search(codes)
        if len(codes) <= 64 and len(self) < CACHED:
            self[codes] = found
        return found


def apply_edits(audit, turns):
    """(role, text) of the repaired conversation; ``turns`` is read as it is needed."""
    turns, state = iter(turns), START
    for letter in audit:
        if letter == "D":
            next(turns)
            continue
        role, text = ("", "") if letter == "I" else next(turns)
        if letter != "K":
            role = NAMES[NEXT[state]]
        state = AFTER_SYSTEM if role[:1] == "s" else LEADS[NEXT[state]]
        yield role, text


class Conversation:
    """What is known of one conversation while its turns stream by: texts up to ``held`` bytes, else codes and digests."""

    def __init__(self, held):
        self.held, self.size, self.turns = held, 0, []
        self.codes, self.seen, self.last = bytearray(), set(), None
        self.blank = self.duplicate = self.truncated = self.illegal = self.different = 0
        self.first_turn = self.last_turn = None

    def add(self, turn, role, text, blank, truncated):
        if turn is not None:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.different += turn != self.last_turn
            self.last_turn = turn
        if self.last is not None and self.last + role[:1] not in LEGAL:
            self.illegal += 1
        self.last = role[:1]
        digest = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())
        code = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1], OTHER)
        if blank:
            self.blank, code = self.blank + 1, GONE
        elif digest in self.seen:
            self.duplicate, code = self.duplicate + 1, GONE
        elif truncated:
            self.truncated, code = self.truncated + 1, code + CUT
        self.seen.add(digest)
        self.codes.append(code)
        self.size += len(role) + len(text)
        if self.size > self.held:
            self.turns = None
        elif self.turns is not None:
            self.turns.append((role, text))

    def report(self, searches):
        cost, audit = searches[bytes(self.codes)]
        gaps = self.last_turn - self.first_turn + 1 - self.different if self.different else 0
        repaired = None
        if self.turns is not None:
            repaired = [{"role": role, "text": text} for role, text in apply_edits(audit, self.turns)]
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, repaired


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])


def _in_order(turns, *first):
    """All turns of a conversation in one partition, by turn, nulls first; equal turns by role and text."""
    order = [F.col(name).asc_nulls_first() for name in ("conv_id", *first, "turn", "role", "text")]
    return turns.repartition("conv_id").sortWithinPartitions(*order)


def _rows(batches):
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def repair(turns, held=HELD_BYTES):
    """One row per ``conv_id`` of ``turns`` (conv_id, turn, role, text): counts of faults, cost, audit and ``repaired``.

    A turn's first fault counts: blank, duplicate (of role and text earlier in the conversation), truncated. ``repaired`` is
    the array of (role, text) after the edits, null for conversations of more than ``held`` characters, whose turns
    ``repaired_turns`` gives. Null roles and texts count as empty; null turns come first and leave gaps alone; all rows with a
    null ``conv_id`` are one conversation. Turns of one number come by role and text, so that the result does not depend on
    how rows were stored. An empty table gives an empty result; other columns are not read.
    """
    rows = turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), *[F.coalesce(name, F.lit("")).alias(name) for name in ("role", "text")]
    )
    text = F.col("text")
    rows = rows.withColumn("blank", ~text.rlike(f"[^{BLANKS}]"))
    rows = rows.withColumn("cut", ~text.rlike(rf"[.!?][{BLANKS}]*\z"))
    kind = dict(rows.dtypes)["conv_id"]

    def stream(batches):
        held_id, found, ready, searches = None, None, [], Searches()

        def batch():
            columns = list(zip(*ready, strict=True))
            kinds = [ids, *[pa.int64()] * len(COUNTS), pa.string(), pa.list_(_TURN)]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            ready.clear()
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", *COUNTS, "audit", "repaired"])

        size = 0
        for record in batches:
            ids = record.schema.field("conv_id").type
            for conv_id, *turn in _rows([record]):
                if found is None or conv_id != held_id:
                    if found is not None:
                        ready.append((held_id, *found.report(searches)))
                        size += found.size
                    held_id, found = conv_id, Conversation(held)
                    if size >= HELD_BYTES or len(ready) >= 2_000:
                        yield batch()
                        size = 0
                found.add(*turn)
        if found is not None:
            ready.append((held_id, *found.report(searches)))
            yield batch()

    counts = ", ".join(f"{name} long" for name in COUNTS)
    schema = f"conv_id {kind}, {counts}, audit string, repaired array<struct<role string, text string>>"
    return _in_order(rows).mapInArrow(stream, schema)


def repaired_turns(turns, reports):
    """(conv_id, place, role, text): the turns after the edits of ``reports`` (conv_id, audit), of the conversations in it.

    The edits stream by in front of the turns of their conversation, so none of them is held but its audit.
    """
    kind = dict(turns.dtypes)["conv_id"]
    names = [F.coalesce(name, F.lit("")).alias(name) for name in ("role", "text")]
    wanted = turns.join(reports.select(F.col("conv_id").alias("wanted")), F.col("conv_id").eqNullSafe(F.col("wanted")), "left_semi")
    rows = wanted.select("conv_id", F.lit(1).alias("head"), F.col("turn").cast("bigint").alias("turn"), *names)
    heads = reports.select("conv_id", F.lit(0).alias("head"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))

    def stream(batches):
        ids = None

        def pieces():
            nonlocal ids
            for record in batches:
                ids = record.schema.field("conv_id").type
                yield from _rows([record])

        def batch(ready):
            kinds = [ids, pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*ready, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "place", "role", "text"])

        rest, ready, size = pieces(), [], 0
        for conv_id, _, _, _, audit in rest:
            own = ((role, text) for _, _, _, role, text in rest)
            for place, (role, text) in enumerate(apply_edits(audit, own)):
                ready.append((conv_id, place, role, text))
                size += len(text) + 50
                if size >= HELD_BYTES // 4:
                    yield batch(ready)
                    ready, size = [], 0
        if ready:
            yield batch(ready)

    return _in_order(rows.unionAll(heads), "head").mapInArrow(stream, f"conv_id {kind}, place long, role string, text string")


def turn_digests(repaired):
    """(conv_id, repaired_sha256) of turns (conv_id, place, role, text): SHA-256 of ``role:text`` lines, read in order."""
    kind = dict(repaired.dtypes)["conv_id"]

    def stream(batches):
        held_id, digest, ids = None, None, None
        done = []
        for record in batches:
            ids = record.schema.field("conv_id").type
            for conv_id, role, text in _rows([record]):
                if digest is None or conv_id != held_id:
                    if digest is not None:
                        done.append((held_id, digest.hexdigest()))
                    held_id, digest = conv_id, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    digest.update(f"\n{role}:{text}".encode())
        if digest is not None:
            done.append((held_id, digest.hexdigest()))
            columns = zip(*done, strict=True)
            arrays = [pa.array(column, kind) for column, kind in zip(columns, (ids, pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "repaired_sha256"])

    order = F.col("conv_id").asc_nulls_first(), "place"
    rows = repaired.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")
    return rows.mapInArrow(stream, f"conv_id {kind}, repaired_sha256 string")


def damaged(conversations):
    """(all ids, turns after damage): what happens to a turn follows from the CRC-32 of ``conv_id:turn``, nulls as one space.

    0 of 20 drops it, 1 empties its text, 2 removes stops, 3 repeats it, 4 gives it to the user.
    """
    rows = conversations.select(
        "conv_id", "turn", *[F.coalesce(name, F.lit(" ")).alias(name) for name in ("role", "text")]
    )
    key = F.concat_ws(":", *[F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    turns = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return conversations.select("conv_id").distinct(), turns.drop("copy")


def repair_digests(ids, turns, held=HELD_BYTES):
    """The report of ``repair`` for all ``ids``, with the SHA-256 of the repaired turns in place of them."""
    found = stored(repair(turns, held), "repaired")
    lines = F.transform("repaired", lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"]))
    short = found.where("repaired IS NOT NULL").withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256))
    columns = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    reports = short.select(columns)
    long = found.where("repaired IS NULL")
    if not long.isEmpty():
        digests = turn_digests(repaired_turns(turns, long.select("conv_id", "audit")))
        digests = digests.withColumnRenamed("conv_id", "own")
        named = long.join(digests, F.col("conv_id").eqNullSafe(F.col("own")), "left")
        empty = F.sha2(F.lit(""), 256)
        reports = reports.unionAll(named.withColumn("repaired_sha256", F.coalesce("repaired_sha256", empty)).select(columns))
    reports = reports.withColumnRenamed("conv_id", "own")
    joined = ids.join(reports, F.col("conv_id").eqNullSafe(F.col("own")), "left").drop("own")
    return joined.na.fill(0, COUNTS).select(
        "conv_id", *COUNTS, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
