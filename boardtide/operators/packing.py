"""Packing ordered lines into messages of a bounded length, one reader at a time.

Where a message breaks depends on everything before it, so one reader's lines are walked in
order.  They are never held together: rows arrive sorted within their partition and stream
through a small state (the open message), and each message leaves as soon as it is full.

A reader of more than LONG_READER lines would keep one task busy long after the others; such
readers' breaks are found in parallel (`breaks`), with the same result.
"""

import pandas as pd
from pyspark.sql import functions as F, types as T

from boardtide import fixed
from boardtide.functions import dates, text
from boardtide.operators.breaks import NODE, PIECE, chunk_of, find_breaks, numbered_sums
from boardtide.session import broadcast_if_small, table_stage

#: Lines of a reader that one task packs.
LONG_READER = 50_000

MESSAGES = T.StructType([
    T.StructField("chat_id", T.StringType()), T.StructField("message_no", T.LongType()),
    T.StructField("message", T.StringType()),
])


class _Open:
    """The message being filled for one reader."""

    def __init__(self, chat, header, limit, repeat):
        self.chat, self.header, self.limit, self.repeat = chat, header, limit, repeat
        self.lines, self.size, self.sent, self.group = [header], len(header), 0, None
        if not repeat:
            self.size += 1

    def close(self):
        self.sent += 1
        return self.chat, self.sent, "\n".join(self.lines)

    def _reopen(self):
        if self.repeat:
            self.lines = [f"{self.header} (cont. {self.sent + 1})"]
            self.size = len(self.lines[0])
            if self.group:
                self.lines.append(self.group)
                self.size += len(self.group) + 1
        else:
            self.lines, self.size = [], 0

    def add(self, line):
        full = self.size + len(line) > self.limit and self.lines
        done = [self.close()] if full else []
        if full:
            self._reopen()
        self.lines.append(line)
        self.size += len(line) + 1
        return done

    def add_group(self, group):
        # a header that opens a continuation is repeated there and then listed again
        self.group = group
        return self.add(group)


def _packer(limit, repeat):
    def pack(batches):
        now = None
        for batch in batches:
            out = []
            for chat, header, group, line in zip(
                    batch["chat_id"], batch["header"], batch["group_line"], batch["line"]):
                if now is None or now.chat != chat:
                    if now is not None:
                        out.append(now.close())
                    now = _Open(chat, header, limit, repeat)
                if group is not None and group != now.group:
                    out.extend(now.add_group(group))
                out.extend(now.add(line))
            if out:
                yield pd.DataFrame(out, columns=["chat_id", "message_no", "message"])
        if now is not None:
            yield pd.DataFrame([now.close()], columns=["chat_id", "message_no", "message"])
    return pack


def _pack(lines, order, limit, repeat, long_reader=LONG_READER, counts=None):
    """`counts` has chat_id and count, where the caller knows them."""
    counts = lines.groupBy("chat_id").count() if counts is None else counts
    many = counts.filter(F.col("count") > long_reader).select("chat_id")
    if many.isEmpty():
        return _pack_streamed(lines, order, limit, repeat)
    stage = table_stage(lines.sparkSession)
    lines, many = stage(lines, "lines"), broadcast_if_small(stage(many, "long-readers"))
    few = _pack_streamed(lines.join(many, "chat_id", "left_anti"), order, limit, repeat)
    return few.unionByName(_pack_parallel(stage, lines.join(many, "chat_id", "left_semi"), order, limit, repeat))


def _pack_streamed(lines, order, limit, repeat):
    ordered = lines.repartition("chat_id").sortWithinPartitions("chat_id", *order)
    return ordered.select("chat_id", "header", "group_line", "line").mapInPandas(
        _packer(limit, repeat), MESSAGES)


def _pack_parallel(stage, lines, order, limit, repeat):
    """Group lines become items of their own, before their first line; every item knows the group
    line that a continuation beginning with it repeats.

    Texts move twice, into order and into chunks; breaks are found from the sizes alone."""
    keys = [c for c in lines.columns if c not in ("chat_id", "header", "group_line", "line")]
    # a row per reader and group
    per_group = stage(lines.groupBy("chat_id", "family_group").agg(
        F.first("header").alias("header"), F.max("group_line").alias("text")), "groups")
    # lines without a group come last and belong to the group before them
    last = stage(per_group.groupBy("chat_id").agg(F.max_by("text", "family_group").alias("_last")), "last-groups")
    rows = lines.join(broadcast_if_small(last), "chat_id").select(
        "chat_id", "header", *keys, F.lit(1).alias("kind"), F.col("line").alias("text"),
        F.coalesce("group_line", "_last").alias("group"))
    groups = per_group.filter("text IS NOT NULL").select(
        "chat_id", "header", *[F.col(c) if c == "family_group" else F.lit(None).cast(lines.schema[c].dataType).alias(c)
                               for c in keys], F.lit(0).alias("kind"), "text", F.col("text").alias("group"))
    repeated = F.length("header") + len(" (cont. )") + F.coalesce(F.length("group") + 1, F.lit(0))
    items = rows.unionByName(groups).withColumns({
        "wide": F.length("text") + 1, "first": F.length("header") + (0 if repeat else 1),
        "more": repeated if repeat else F.lit(None).cast("int")})
    placed = numbered_sums(stage, items, [order[0], "kind", *order[1:]], [("wide", "begin")], "ranged")
    sizes = stage(placed.select(*NODE, "begin", (F.col("begin") + F.col("wide") - 1).alias("end"), "first", "more"), "sizes")
    breaks = stage(find_breaks(stage, sizes, limit), "breaks").withColumn("chunk", chunk_of("idx", limit))
    # a chunk knows its own breaks and the last one before it, which is in the chunk before
    before = breaks.groupBy(*PIECE).agg(F.max("idx").alias("idx"), F.max("message_no").alias("message_no")).withColumn(
        "chunk", F.col("chunk") + 1)
    told = placed.select(*NODE, chunk_of("idx", limit), "header", "text", "group")
    parts = stage(told.groupBy(*PIECE).cogroup(breaks.unionByName(before).groupBy(*PIECE)).applyInPandas(
        _chunk_messages(repeat), PARTS), "parts")
    split = parts.filter("NOT whole").groupBy("chat_id", "message_no").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "message"))), lambda x: x["message"]), "\n").alias("message"))
    return parts.filter("whole").select("chat_id", "message_no", "message").unionByName(split)


PARTS = T.StructType([*MESSAGES, T.StructField("chunk", T.LongType()), T.StructField("whole", T.BooleanType())])


def _chunk_messages(repeat):
    """The messages of a chunk; the first and the last of them may be parts of one."""
    def messages(key, lines, breaks):
        columns = PARTS.fieldNames()
        if not len(lines):
            return pd.DataFrame([], columns=columns)
        lines = lines.sort_values("idx")
        start = int(lines["idx"].iloc[0])
        number = dict(zip(breaks["idx"], breaks["message_no"]))
        first = max((int(n) for i, n in number.items() if i < start), default=1)
        cuts = [int(i) - start for i in sorted(number) if i >= start]
        texts, heads, groups = (lines[c].tolist() for c in ("text", "header", "group"))
        out, at = [], 0
        for n, cut in enumerate([*cuts, len(texts)]):
            no, opening = first + n, []
            if n and repeat:
                opening = [f"{heads[at]} (cont. {no})", *([groups[at]] if isinstance(groups[at], str) else [])]
            elif not n and not start:
                opening = [heads[0]]
            if opening or cut > at:
                begins, ends = bool(n or not start), n < len(cuts)
                out.append((key[0], no, "\n".join([*opening, *texts[at:cut]]), key[1], begins and ends))
            at = cut
        return pd.DataFrame(out, columns=columns)
    return messages


def _when(posted="posted_date", first_seen="first_seen"):
    return dates.shown_date(posted, first_seen)


def render_digest(matches, snapshot, limit=fixed.DIGEST_CHARS, long_reader=LONG_READER):
    """chat_id, message_no, message: grouped by family, group header repeated on continuation.

    Totals per reader and per group come from a combined aggregation joined back, not from a
    window over all of a reader's rows.
    """
    stage = table_stage(matches.sparkSession)
    per_group = stage(matches.groupBy("chat_id", "family_group").agg(F.count("*").alias("n_group")), "counts")
    totals = stage(per_group.groupBy("chat_id").agg(F.sum("n_group").alias("n_all")), "totals")
    short = lambda c, n: F.left(text.blank_to_empty(c), F.lit(n))
    title = text.escape_markup(short("title", fixed.DIGEST_TITLE_CHARS))
    firm = text.escape_markup(short("firm_name", fixed.DIGEST_FIRM_CHARS))
    lines = matches.join(broadcast_if_small(per_group), ["chat_id", "family_group"]).join(
        broadcast_if_small(totals), "chat_id").select(
        "chat_id", "family_group", "posted_date", "job_key",
        F.concat(F.lit("<b>🎓 "), "n_all", F.lit(" new graduate role(s)</b> · "),
                 F.lit(str(snapshot))).alias("header"),
        F.concat(F.lit("\n<b>"), text.escape_markup("family_group"), F.lit("</b> ("), "n_group",
                 F.lit(")")).alias("group_line"),
        F.concat(F.lit('• <a href="'), text.escape_markup(text.blank_to_empty("apply_url")),
                 F.lit('">'), title,
                 F.lit("</a>\n  "), firm, F.lit(" · "), _when()).alias("line"))
    order = [F.asc_nulls_last("family_group"), F.desc_nulls_last("posted_date"), F.asc("job_key")]
    return _pack(lines, order, limit, True, long_reader, totals.withColumnRenamed("n_all", "count"))


def render_reply(matches, heading, limit=fixed.REPLY_CHARS, long_reader=LONG_READER):
    """Plain reply: one heading, rows in digest order, nothing repeated on continuation."""
    lines = matches.select(
        "chat_id", "family_group", "posted_date", "job_key", F.lit(heading).alias("header"),
        F.lit(None).cast("string").alias("group_line"),
        F.concat(F.lit('• <a href="'), text.blank_to_empty("apply_url"), F.lit('">'),
                 F.left(text.blank_to_empty("title"), F.lit(fixed.REPLY_TITLE_CHARS)),
                 F.lit("</a>\n  "),
                 F.left(text.blank_to_empty("firm_name"), F.lit(fixed.REPLY_FIRM_CHARS)),
                 F.lit(" · "),
                 _when()).alias("line"))
    order = [F.asc_nulls_last("family_group"), F.desc_nulls_last("posted_date"), F.asc("job_key")]
    return _pack(lines, order, limit, False, long_reader, matches.groupBy("chat_id").count())


def write_digest(messages, path):
    """Dry-run sink: every message as one text record, followed by a rule line."""
    (messages.repartitionByRange("chat_id", "message_no")
     .sortWithinPartitions("chat_id", "message_no")
     .select(F.concat("message", F.lit(fixed.DIGEST_RULE)).alias("value"))
     .write.mode("overwrite").text(path))
