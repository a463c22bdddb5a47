"""Personal data by weak supervision.  DataFrame functions only.

Candidates of every kind are found by wide patterns.  Labelers vote on each: a strict pattern, a
gazetteer, the words around it, its shape.  Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is, and its posteriors train a logistic span
classifier on the votes.  Candidates the classifier accepts are added to the base spans, which are
all kept whatever it says.
"""

import math

from pyspark.sql import functions as F

from boardtide.llm.common import Stage, free_name, located, rows_of

KINDS = ("email", "ip", "card", "phone", "secret")
_LOCAL = "A-Za-z0-9._%+-"
# The lookbehind starts a run only where it begins or where the last match ended: the same matches
# as without it, but linear in a long run.  Possessive parts cannot change a match here.
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9.-]++",
    "ip": r"(?:(?<![0-9a-fA-F:])|\G)(?:[0-9a-fA-F]{1,4}+:){7}[0-9a-fA-F]{1,4}(?![0-9a-fA-F:])",
    "card": r"(?<![0-9+])[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![0-9A-Za-z])[0-9a-f]{32,128}(?![0-9A-Za-z])",
}
GAZETTEER = {
    "email": r"(?i)\.(com|org|net|edu|gov|info|de|fr|es|uk|eu|io)$",
    "ip": r"(?i)^(10|127|172|192|fe80|2001)[.:]",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"555|^\(?[2-9]",
    "secret": r"^([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{128})$",
}
CONTEXT = {
    "email": r"(?i)(mail|contact|write|@)",
    "ip": r"(?i)(\bip\b|address|host|server)",
    "card": r"(?i)(card|visa|master|credit|pay)",
    "phone": r"(?i)(phone|call|tel|mobile|fax|contact)",
    "secret": r"(?i)(token|key|secret|password|passwd|api)",
}
LABELERS = ("strict", "gazetteer", "context", "shape")
AROUND = 40


def _digits(text):
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits):
    """Whether a digit string passes the Luhn check."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
            i % 2 == 0, c.cast("int")).otherwise(
            F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int")))),
        F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0)))
    return total % 10 == 0


def valid(kind, text):
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return text.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        n = F.length(_digits(text))
        return n.between(13, 19) & F.when(n.between(13, 19), luhn(_digits(text))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    return F.lit(True)


def spans_of(text, pattern):
    """Array of (start, end, found) of the pattern's matches, in code points.

    Splitting by the pattern gives the lengths of what lies between the matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda s: F.length(s))
    steps = F.zip_with(F.slice(between, 1, F.greatest(F.size(found), F.lit(1))), found,
                       lambda gap, f: F.struct(gap.alias("gap"), f.alias("found")))
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")

    def add(acc, s):
        begin = acc["at"] + s["gap"]
        stop = begin + F.length(s["found"])
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(
            begin.alias("start"), stop.alias("end"), s["found"].alias("found")))).alias("out"))

    walked = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("out")), add,
                         lambda acc: acc["out"])
    return F.when(F.size(found) == 0, none).otherwise(walked)


def _kind_spans(kind, text):
    return F.filter(spans_of(text, BASE[kind]), lambda s: valid(kind, s["found"]))


def base_spans(docs):
    """docs with one array per kind; null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    has = {"email": F.contains(text, F.lit("@")), "ip": F.contains(text, F.lit(".")),
           "card": F.lit(True), "phone": F.contains(text, F.lit("+"))}
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return docs.select("*", *[
        F.when(has[k], _kind_spans(k, text)).otherwise(none).alias(k) for k in BASE])


def _apart_from(kind):
    return lambda s: ~F.exists(F.col(kind), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


def _with_votes(kind, spans, text, base):
    bit = lambda test: test.cast("int").cast("string")

    def vote(s):
        before = F.substring(text, F.greatest(s["start"] + 1 - AROUND, F.lit(1)),
                             F.least(s["start"], F.lit(AROUND)))
        plain = F.regexp_replace(s["found"], "[^0-9A-Za-z]", "")
        return F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.concat(F.lit(str(int(base))), bit(s["found"].rlike(GAZETTEER[kind])),
                     bit(before.rlike(CONTEXT[kind])), bit(F.length(plain) >= 8)).alias("votes"),
            F.lit(base).alias("base"))

    return F.transform(spans, vote)


def candidates(text):
    """Array of (kind, start, end, votes, base) over base and wide matches."""
    parts = []
    for kind in KINDS:
        wide = spans_of(text, WIDE[kind])
        if kind in BASE:
            parts.append(_with_votes(kind, F.col(kind), text, True))
            wide = F.filter(wide, _apart_from(kind))
        parts.append(_with_votes(kind, wide, text, False))
    return F.concat(*parts)


def expectation_maximisation(counts, rounds=50):
    """Posterior that a span is personal data, per (kind, votes), from counts of vote patterns.

    `counts`: {(kind, votes): n}.  Reliabilities are shared by the kinds, with one pseudo-vote
    each way; each kind has its own share of true spans.
    """
    m = len(LABELERS)
    yes, no, share = [0.8] * m, [0.3] * m, {k: 0.5 for k, _ in counts}
    post = {}
    for _ in range(rounds):
        for (kind, votes), _n in counts.items():
            a, b = math.log(share[kind]), math.log(1 - share[kind])
            for j, v in enumerate(votes):
                a += math.log(yes[j] if v == "1" else 1 - yes[j])
                b += math.log(no[j] if v == "1" else 1 - no[j])
            post[kind, votes] = 1 / (1 + math.exp(min(50.0, b - a)))
        true = sum(n * post[c] for c, n in counts.items())
        false = sum(counts.values()) - true
        for j in range(m):
            up = sum(n * post[c] for c, n in counts.items() if c[1][j] == "1")
            down = sum(n * (1 - post[c]) for c, n in counts.items() if c[1][j] == "1")
            yes[j], no[j] = (4 + up) / (5 + true), (1.5 + down) / (5 + false)
        for kind in share:
            mine = [(n, post[c]) for c, n in counts.items() if c[0] == kind]
            share[kind] = (1 + sum(n * p for n, p in mine)) / (2 + sum(n for n, _ in mine))
    return post


def span_classifier(counts, post, rounds=400, rate=0.5, ridge=1e-3):
    """Logistic weights (bias, one per labeler) fitted to the posteriors."""
    total = sum(counts.values()) or 1
    w = [0.0] * (len(LABELERS) + 1)
    for _ in range(rounds):
        grad = [ridge * x for x in w]
        for c, n in counts.items():
            x = [1.0] + [float(v) for v in c[1]]
            p = 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(a * b for a, b in zip(w, x, strict=True))))))
            for j, v in enumerate(x):
                grad[j] += n * (p - post[c]) * v / total
        w = [a - rate * g for a, g in zip(w, grad, strict=True)]
    return w


def find_spans(spark, docs, stage=None, row=None):
    """row, doc_id, one array per base kind, and `all`: every span (kind, start, end, base).

    A null text counts as empty and has no spans.  Of overlapping spans of one kind the base span
    stays.  An empty table gives no rows.
    """
    stage = stage or Stage(spark, "pii")
    text = F.coalesce(F.col("text"), F.lit(""))
    found = base_spans(rows_of(docs, row, "doc_id", "text"))
    found = stage.keep(found.select(
        "row", "doc_id", *[F.transform(k, lambda s: s.dropFields("found")).alias(k) for k in BASE],
        candidates(text).alias("spans")), "candidates")
    # at most kinds x 2^labelers rows, whatever the corpus
    votes = found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes").count().collect()
    counts = {(r["kind"], r["votes"]): r["count"] for r in votes}
    w = span_classifier(counts, expectation_maximisation(counts))

    def accepted(s):
        z = F.lit(w[0])
        for j, weight in enumerate(w[1:]):
            z = z + F.substring(s["votes"], j + 1, 1).cast("int") * F.lit(weight)
        return s["base"] | (z > 0)

    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    return found.select(
        "row", "doc_id", *BASE,
        F.transform(F.array_sort(F.transform(F.filter("spans", accepted), lambda s: F.struct(
            rank[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
            s["kind"].alias("kind"), s["base"].alias("base")))), lambda s: s.dropFields("rank")).alias("all"))


def span_text(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(spark, docs):
    """`docs` (a stored table) with every span in `text` replaced by its kind in brackets, and
    `n_chars`, where there is one, brought up to date.  A null text stays null."""
    columns, stage, held = docs.columns, Stage(spark, "pii"), free_name(docs, "__spans")
    docs, row = located(stage, docs)
    spans = find_spans(spark, docs, stage, row).select(F.col("row").alias(row), F.array_sort(F.transform(
        "all", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                  s["kind"].alias("kind")))).alias(held)).filter(F.size(held) > 0)
    text = F.col("text")

    def cut(acc, s):
        begin = F.greatest(acc["at"], s["start"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(
                acc["out"], F.array(text.substr(acc["at"] + 1, begin - acc["at"]),
                                    F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))).alias("out"))

    clean = F.aggregate(
        held, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), cut,
        lambda acc: F.concat(F.array_join(acc["out"], ""), text.substr(acc["at"] + 1, F.length(text))))
    out = docs.join(spans, row, "left").withColumn(
        "text", F.when(F.col(held).isNull(), text).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(held).isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(dict(docs.dtypes)["n_chars"])))
    return out.select(*columns)
