"""Finding the board of a firm in a landed census of boards."""

from pyspark.sql import functions as F, Window as W

from boardtide import fixed
from boardtide.functions import names, similarity, text, urls


def board_census(postings, place=fixed.PLACE, order="posting_ord"):
    """platform, token -> total, in_place, board_name, sample_url of each probed board."""
    first = lambda c: F.min_by(text.blank_to_empty(c), order)
    return postings.groupBy("platform", "token").agg(
        F.count("*").alias("total"),
        F.count_if(text.mentions_place("location", place=place)).alias("in_place"),
        first("board_name").alias("board_name"), first("url").alias("sample_url"))


def firm_tokens(firms):
    """firm_id, firm_name, token, token_ord: the blocking keys, most likely first."""
    return firms.select("firm_id", "firm_name", F.posexplode(
        names.board_tokens("firm_id", "firm_name")).alias("token_ord", "token"))


def firm_tenants(firms):
    return firms.select("firm_id", "firm_name", F.posexplode(
        names.tenant_tokens("firm_id", "firm_name")).alias("token_ord", "token"))


def match_boards(firms, census):
    """Boards found under any token of a firm, up to its first non-empty one per platform.

    Empty boards before that one stay in the result: they were seen, they just prove nothing.
    A firm has at most a few dozen tokens, so the window below is small for every key.
    """
    hits = firm_tokens(firms).join(census, "token")
    w = W.partitionBy("firm_id", "platform")
    stop = F.min(F.when(F.col("total") > 0, F.col("token_ord"))).over(w)
    return hits.withColumn("_stop", stop).filter(
        F.col("_stop").isNull() | (F.col("token_ord") <= F.col("_stop"))).drop("_stop")


def verify_boards(hits, place_name=fixed.PLACE_NAME):
    """Add `verified` and `reason`: may this board be trusted to belong to the firm?"""
    target, board = names.board_denoise("firm_name"), names.board_denoise("board_name")
    domain = urls.apply_domain("sample_url")
    # everything before the last two labels; a two-label host stands for itself without its end
    labels = F.split(F.col("_domain"), r"\.")
    core = F.when(F.size(labels) > 2, F.array_join(F.slice(
        labels, 1, F.greatest(F.size(labels) - 2, F.lit(1))), ".")).otherwise(labels[0])
    staged = hits.select(
        "*", target.alias("_target"), board.alias("_board"), domain.alias("_domain"))
    staged = staged.select(
        "*", names.squash("_target").alias("_t"), names.squash("_board").alias("_b"),
        names.squash(core).alias("_core"), names.squash("token").alias("_tok"))
    scored = staged.select(
        "*", similarity.token_set_ratio("_board", "_target", fixed.BOARD_NAME_THRESHOLD).alias("_name_score"),
        F.greatest(similarity.partial_ratio("_core", "_t"),
                   similarity.token_set_ratio("_core", "_t", fixed.BOARD_NAME_THRESHOLD)).alias("_domain_score"),
        similarity.ratio("_tok", "_t").alias("_token_score"))
    shorter = F.least(F.length("_b"), F.length("_t"))
    words = F.size(F.filter(F.split("_board", r"(?U)\s+"), lambda x: x != ""))
    coverage = F.length("_b") / F.greatest(F.length("_t"), F.lit(1))
    name_agrees = ((F.col("board_name") != "")
                   & (F.col("_name_score") >= fixed.BOARD_NAME_THRESHOLD)
                   & (shorter >= fixed.MIN_SUBSET_CHARS)
                   & ((words > 1) | (coverage >= fixed.MIN_ONE_WORD_COVERAGE)))
    steps = [
        (F.col("total") <= 0, False, "empty board"),
        (F.length("token") < fixed.MIN_TRUSTED_TOKEN_CHARS, False, "token too short to trust"),
        (name_agrees, True, "board name matches"),
        ((F.col("_domain") != "") & (F.col("_domain_score") >= fixed.BOARD_NAME_THRESHOLD), True,
         "apply domain matches"),
        (F.col("_domain") != "", False, "apply domain is another company"),
        (F.col("board_name") != "", False, "board name is another company"),
        (F.col("_token_score") < fixed.BOARD_TOKEN_THRESHOLD, False, "nothing to verify against"),
        (F.col("in_place") <= 0, False, f"token matches but no {place_name} roles"),
    ]
    return _decide(scored, steps, "token matches", hits.columns)


def _decide(df, steps, otherwise, columns):
    ok = reason = None
    for test, yes, why in steps:
        ok = F.when(test, yes) if ok is None else ok.when(test, yes)
        reason = F.when(test, why) if reason is None else reason.when(test, why)
    return df.select(*columns, ok.otherwise(True).alias("verified"),
                     reason.otherwise(otherwise).alias("reason"))


def verify_tenants(hits):
    """The same question for tenants: not empty, and the tenant name resembles the firm's."""
    scored = hits.withColumn("_score", similarity.partial_ratio(
        names.squash("tenant"), names.squash(names.tenant_denoise("firm_name"))))
    steps = [(F.col("total") <= 0, False, "board returns no postings"),
             (F.col("_score") < fixed.TENANT_THRESHOLD, False, "tenant does not resemble the firm")]
    return _decide(scored, steps, "tenant resembles the firm", hits.columns)


def best_board(hits, order="board_ord"):
    """One verified board per firm: most rows in place, then most rows, first wins ties."""
    rank = F.struct("in_place", "total", (-F.col(order)).alias("earliest"))
    return _best(hits.filter("verified"), ["firm_id"], rank)


def best_site(hits, order="site_ord"):
    """One site per firm, host and tenant: in place, resemblance to the firm, total, first wins."""
    scored = hits.withColumn("_like", F.floor(similarity.partial_ratio(
        names.squash("site"), names.squash(names.tenant_denoise("firm_name")))))
    rank = F.struct("in_place", "_like", "total", (-F.col(order)).alias("earliest"))
    return _best(scored, ["firm_id", "host", "tenant"], rank).drop("_like")


def _best(df, keys, rank):
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_b"))
            .select(*keys, "_b.*"))


def registry_hits(best):
    """Best boards in the shape the registry upsert takes."""
    return best.select(
        "firm_id", F.col("platform").alias("ats_platform"), F.col("token").alias("ats_token"),
        F.concat(F.lit("discovered "), F.col("total").cast("string"), F.lit(" jobs ("),
                 F.col("in_place").cast("string"), F.lit(" SG); "), "reason").alias("note"))
