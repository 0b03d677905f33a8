"""URL filters: listed rules first, then association rules mined from labelled addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.session import stored

#: (host, path, verdict); a rule fits its host and all subdomains if the path starts with the rule's
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = "verdict=block"
LEAST_SUPPORT, LEAST_CONFIDENCE = 0.001, 0.9
#: names of an address up to which FP-growth may make all combinations of them; longer ones are mined name by name
MOST_TOKENS = 10
#: equal addresses that one row stands for while they are dealt out
PORTION = 1_000


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host/path`` text, and its verdict; null without one."""
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [(((host == h) | host.endswith("." + h)) & path.startswith(p), h + p, v) for h, p, v in ranked]
    first = lambda i: reduce(lambda rest, f: F.when(f[0], F.lit(f[i])).otherwise(rest), reversed(fits), F.lit(None).cast("string"))
    return first(1), first(2)


def tokens(host: Column, path: Column) -> Column:
    """The distinct parts of host and path, sorted: ``h:`` host labels and their hyphenated parts, ``p:`` path words; numbers are ``#``."""
    parts = lambda c, sep, mark: F.transform(F.filter(F.split(c, sep), lambda x: x != ""),
                                             lambda x: F.concat(F.lit(mark), F.regexp_replace(x, "[0-9]+", "#")))
    return F.array_sort(F.array_distinct(F.concat(parts(host, r"\.", "h:"), parts(host, "[.-]", "h:"), parts(F.lower(path), "[/._-]", "p:"))))


def token_names(labelled: DataFrame) -> DataFrame:
    """``token, name, n``: tokens that the same labelled addresses have share a name, the smallest of them; ``n`` addresses have it.

    Whether they do is read from counts and sums of address hashes; such tokens say the same, but would
    make 2 ** n combinations of n words that always come together.
    """
    rows = labelled.select(F.xxhash64("tokens").cast("decimal(20,0)").alias("own"), F.xxhash64(F.lit(1), "tokens").alias("other"), F.explode("tokens").alias("token"))
    marks = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("own"), F.bit_xor("other").alias("other"))
    named = marks.join(marks.groupBy("n", "own", "other").agg(F.min("token").alias("name")), ["n", "own", "other"])
    return stored(named.select("token", "name", "n"), "token-names")


def told_sets(labelled: DataFrame, names: DataFrame, least_support: float) -> tuple[DataFrame, DataFrame]:
    """The distinct token sets as ``id, n, b, items`` and the names as ``token, n, b``; ``n`` addresses have them, ``b`` of them blocked.

    ``names`` are those of enough blocked addresses, for a rule with any other has too few.  ``items`` are the ones that some
    allowed address has as well; a name of blocked addresses only is a rule, and nothing more certain contains it.
    """
    size = labelled.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    sets = labelled.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("b"))
    sets = stored(sets.withColumn("id", F.monotonically_increasing_id()), "token-sets")
    having = sets.select("id", "n", "b", F.explode("tokens").alias("token")).join(names.where("token = name").select("token"), "token")
    told = having.groupBy("token").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).where(F.col("b") >= least_support * size)
    told = stored(told.withColumn("size", size), "told")
    items = having.select("id", "token").join(told.where("b < n").select("token"), "token").groupBy("id").agg(F.array_sort(F.collect_list("token")).alias("items"))
    whole = sets.drop("tokens").join(items, "id", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return stored(whole, "told-sets"), told


def baskets(sets: DataFrame) -> DataFrame:
    """``items``: a row for each address again, with BLOCK if it is blocked; those of one set that many have are dealt out in portions."""
    bad = F.struct(F.concat("items", F.array(F.lit(BLOCK))).alias("items"), F.col("b").alias("times"))
    good = F.struct(F.col("items").alias("items"), (F.col("n") - F.col("b")).alias("times"))
    kinds = sets.select("id", F.inline(F.array(bad, good))).where("times > 0")
    portions = kinds.select("id", "items", "times", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / PORTION).cast("int"))).alias("portion"))
    rest = F.least(F.lit(PORTION), F.col("times") - PORTION * F.col("portion")).cast("int")
    return portions.repartition(F.xxhash64("id", "items", "portion")).select(F.explode(F.array_repeat("items", rest)).alias("items"))


def by_growth(sets: DataFrame, least_support: float, least_confidence: float) -> DataFrame:
    """Rules of any number of names, by FP-growth over whole baskets: ``antecedent, confidence, support``; none has a part as confident."""
    model = FPGrowth(itemsCol="items", minSupport=least_support, minConfidence=least_confidence).fit(stored(baskets(sets), "baskets"))
    rules = stored(model.associationRules.where(F.element_at("consequent", 1) == BLOCK).select(
        F.array_sort("antecedent").alias("antecedent"), "confidence", "support"), "rules")
    masks = F.sequence(F.lit(1), F.expr("cast(shiftleft(1, size(antecedent)) - 2 as int)"))
    part = F.transform(masks, lambda m: F.filter("antecedent", lambda x, i: F.getbit(m, i) == 1))
    parts = rules.where(F.size("antecedent") > 1).select("antecedent", "confidence", F.explode(part).alias("part"))
    known = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("part_confidence"))
    beaten = parts.join(known, "part").where(F.col("part_confidence") >= F.col("confidence")).select("antecedent").distinct()
    return rules.join(beaten, "antecedent", "left_anti")


def by_levels(sets: DataFrame, told: DataFrame, least_support: float, least_confidence: float) -> DataFrame:
    """The rules of ``by_growth`` where addresses are long, a name more in each round.

    Only combinations that can still grow into a rule do: each part is shared by more addresses (else the part says the same)
    and some allowed address has it (else nothing is more certain), so the many combinations of a sure pair are not made.
    Counts are over whole token sets.  A set's combinations are rows, by their first names, so they are counted
    before any shuffle and no task holds all of a set's.
    """
    rule = lambda level: level.where((F.col("confidence") >= least_confidence) & (F.col("confidence") > F.col("best"))).select(
        "antecedent", "confidence", (F.col("b") / F.col("size")).alias("support"))
    level = told.where("b < n").select(F.array("token").alias("antecedent"), "n", "b", "size", (F.col("b") / F.col("n")).alias("confidence"), F.lit(0.0).alias("best"))
    held = sets.select("id", "n", "b", F.array().cast("array<string>").alias("head"), F.col("items").alias("lasts"))
    size, rules = told.agg(F.any_value("size").alias("size")).select("size").scalar(), [rule(level)]
    while True:
        known = level.where("confidence < 1").select(F.col("antecedent").alias("part"), F.col("n").alias("part_n"), F.greatest("confidence", "best").alias("part_best"))
        held = held.where("size(lasts) > 1").select("id", "n", "b", "head", "lasts", F.explode(F.sequence(F.lit(1), F.size("lasts") - 1)).alias("at"))
        held = held.select("id", "n", "b", F.concat("head", F.slice("lasts", F.col("at"), F.lit(1))).alias("head"),
                           F.slice("lasts", F.col("at") + 1, F.size("lasts")).alias("lasts"))
        each = held.select("id", "n", "b", "head", F.explode("lasts").alias("last")).withColumn("antecedent", F.concat("head", F.array("last")))
        counted = each.groupBy("antecedent").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).where(F.col("b") >= least_support * size)
        part = F.transform("antecedent", lambda _, k: F.filter("antecedent", lambda x, i: i != k))
        checked = counted.select("antecedent", "n", "b", F.explode(part).alias("part")).join(known, "part").groupBy("antecedent", "n", "b").agg(
            F.count(F.lit(1)).alias("parts"), F.min("part_n").alias("least_n"), F.max("part_best").alias("best"))
        grown = checked.where("parts = size(antecedent) AND n < least_n")
        level = stored(grown.select("antecedent", "n", "b", size.alias("size"), (F.col("b") / F.col("n")).alias("confidence"), "best"), "grown")
        rules.append(rule(level))
        still = level.where("confidence < 1").select("antecedent")
        if still.isEmpty():
            return reduce(DataFrame.unionByName, rules)
        held = stored(each.join(still, "antecedent", "left_semi").groupBy("id", "n", "b", "head").agg(F.array_sort(F.collect_list("last")).alias("lasts")), "held")


def mine(labelled: DataFrame, names: DataFrame, least_support: float = LEAST_SUPPORT, least_confidence: float = LEAST_CONFIDENCE,
         most_tokens: int = MOST_TOKENS) -> DataFrame:
    """Token combinations that say block: ``antecedent array<string>, confidence, support, index_token``.

    ``labelled`` has ``tokens`` and ``blocked`` (boolean).  Tokens that always come together count as one, by their
    name (``token_names``).  A rule stays with enough confidence and support and if no part of it is as confident.  Its rarest
    token is the one it is found by.  FP-growth finds the frequent combinations where no address has more than ``most_tokens``
    names to combine, for it makes all combinations of an address; longer ones are mined by ``by_levels``.  Both count whole
    addresses and give the same rules.
    """
    sets, told = told_sets(labelled, names, least_support)
    longest = sets.agg(F.max(F.size("items"))).first()[0]
    mined = by_growth(sets, least_support, least_confidence) if (longest or 0) <= most_tokens else by_levels(sets, told, least_support, least_confidence)
    sure = told.where("b = n").select(F.array("token").alias("antecedent"), F.lit(1.0).alias("confidence"), (F.col("b") / F.col("size")).alias("support"))
    kept = stored(mined.select("antecedent", "confidence", "support").unionByName(sure), "kept")
    single = names.select("token", F.col("n").alias("freq"))
    rarest = kept.select("antecedent", F.explode("antecedent").alias("token")).join(single, "token").groupBy("antecedent").agg(
        F.min_by("token", F.struct("freq", "token")).alias("index_token"))
    return kept.join(rarest, "antecedent")


def match(sets: DataFrame, rules: DataFrame, names: DataFrame) -> DataFrame:
    """Token sets that some rule covers: ``tokens, confidence`` of the most confident one.

    A token stands for its name, so any of the tokens that always came together will do.  The inverted index
    holds each rule under its rarest name only, so a name of every address finds few rules.
    """
    named = sets.select("tokens", F.explode("tokens").alias("token")).join(names.select("token", "name"), "token")
    named = named.groupBy("tokens").agg(F.collect_set("name").alias("names"))
    found = named.select("tokens", "names", F.explode("names").alias("index_token")).join(rules, "index_token")
    covered = found.where(F.size(F.array_except("antecedent", "names")) == 0)
    return covered.groupBy("tokens").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame | None = None, rules=RULES, least_support: float = LEAST_SUPPORT,
          least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """Every address with its verdict: ``page_id, host, path, rule, verdict, confidence``.

    A listed rule decides where one fits.  The other verdicts come from mined rules: block if a
    mined combination is in the address, else allow.  Labels to mine from are the verdicts of
    the listed rules, and for other addresses the row of ``labels`` with doc_id = page_id
    (quality 0 or toxic 1 is block), where there is one.

    A null url, or one without ``://``, has empty host and path, no tokens, and is allowed.
    Equal addresses get equal verdicts; rows with equal or null page_id all stay; other columns go.
    """
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("listed"), tokens(F.col("host"), F.col("path")).alias("tokens"))
    blocked = F.when(F.col("listed").isNotNull(), F.col("listed") == "block")
    labelled = rows
    if labels is not None:
        marks = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
            F.max(((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1))).alias("bad"))
        labelled = rows.join(marks, "page_id", "left")
        blocked = blocked.otherwise(F.col("bad"))
    labelled = labelled.select("tokens", blocked.alias("blocked")).where(F.col("blocked").isNotNull() & (F.size("tokens") > 0))
    labelled = stored(labelled, "labelled")
    names = token_names(labelled)
    mined = stored(mine(labelled, names, least_support, least_confidence), "mined")
    # stored, so that the join can split a token set that many addresses have
    hits = stored(match(rows.where("listed IS NULL AND size(tokens) > 0").select("tokens").distinct(), mined, names), "hits")
    judged = rows.join(hits, "tokens", "left")
    other = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("listed", other).alias("verdict"),
                         F.when(F.col("listed").isNull(), F.col("confidence")).alias("confidence"))


def op8_url_filters(pages: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(pages, labels)
