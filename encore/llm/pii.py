"""Personal data: fixed kinds, and more identifiers by bootstrapping from their contexts.

All of it is DataFrame and SQL functions.

*Base kinds.* E-mail addresses, IPv4 addresses, card numbers and phone numbers as given by
``KINDS``, leftmost first and without overlap within a kind; a match that fails its check is
dropped. Positions are those of code points: a text is split at the matches, and running
sums of the lengths of gaps and matches are the starts. The expressions are written so that
Java's matcher neither recurses nor goes over a run of characters twice, however long it
is; for that, separators inside a match are first replaced by private-use characters.

*Bootstrapping.* Any other run of letters, digits, ``_`` and ``-`` of at least eight
characters with two digits is a candidate. Contexts are lexical patterns: the word before
(with what ties it to the candidate, such as ``password=``) and the word after. Patterns
and instances (texts of candidates, and the base entities as seeds) make a graph, which is
scored in rounds:

- a pattern's confidence is the mean confidence of its distinct instances, ``SMOOTH``
  unknown ones added;
- an instance's confidence is that of several independent patterns, counting those of at
  least ``TRUSTED`` with ``SUPPORT`` instances. Seeds stay at 1.

So seeds make patterns trustworthy, these discover identifiers, and those make further
patterns trustworthy that no seed ever had. Candidates whose text reaches ``ACCEPT`` become
spans of kind ``id``. Base spans always stay as they are.

Defined results: a null or empty text has no spans; rows that repeat are reported each;
empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.scratch import stage

TIE, DOT = "\ue000", "\ue001"
SMOOTH = 2.0
TRUSTED = 0.6
SUPPORT = 3
ACCEPT = 0.8
STILL = 0.001
NEAR = 40  # characters next to a match that its context is taken from; of a longer word, its nearest ones

BASE = ("email", "ip", "card", "phone")
#: Kind -> regular expression over the prepared text. ``\G`` is the end of the match before.
KINDS = {
    "email": (
        rf"(?:(?<![A-Za-z0-9._%+{DOT}-])|\G)[A-Za-z0-9._%+{DOT}-]++@(?=[A-Za-z0-9-]++{DOT})[A-Za-z0-9{DOT}-]++"
    ),
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9][0-9{TIE}]+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "id": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9][A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{8,}",
}


def _prepared(text: Column) -> dict[str, Column]:
    """The text as each kind reads it, or null where it cannot hold one."""
    text = F.translate(text, TIE + DOT, "\ufffd\ufffd")  # in a text they are no separators
    tied = F.regexp_replace(text, r"(?<=[0-9])[\x20-](?=[0-9])", TIE)
    dotted = F.regexp_replace(text, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT)
    return {
        "email": F.when(F.contains(text, F.lit("@")), dotted),
        "ip": F.when(text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), text),
        "card": F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), tied),
        "phone": F.when(F.contains(text, F.lit("+")), text),
        "id": F.when(text.rlike(r"[0-9][A-Za-z_-]*+[0-9]"), text),
    }


def _luhn(digits: Column) -> Column:
    at = F.sequence(F.lit(1), F.length(digits))
    digit = lambda i: F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
    twice = lambda i: digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)
    total = F.aggregate(at, F.lit(0), lambda s, i: s + F.when(i % 2 == 0, twice(i)).otherwise(digit(i)))
    return total % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    plain = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    small = lambda p: (F.length(plain(p)) <= 3) & (plain(p).try_cast("int") <= 255)
    return (
        F.when(kind == "ip", F.forall(F.split(match, r"\."), small))
        .when(kind == "card", F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(True)
    )


def find_hits(docs: DataFrame) -> DataFrame:
    """(row, doc_id, hits): one row per document, written once, with the matches of all kinds.

    What is written fixes the numbers of the rows, whatever is computed again later.
    """
    kinds = [c.alias(k) for k, c in _prepared(F.coalesce("text", F.lit(""))).items()]
    prepared = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", *kinds)
    cut = prepared.select(
        "row", "doc_id", *KINDS, *[F.split(F.col(k), r, -1).alias(f"{k}_gaps") for k, r in KINDS.items()]
    )

    def hits(kind: str, regex: str) -> Column:
        gaps = F.col(f"{kind}_gaps")
        return F.transform(
            F.regexp_extract_all(F.col(kind), F.lit(regex), F.lit(0)),
            lambda match, i: F.struct(
                F.lit(kind).alias("kind"), i.alias("place"), F.length(F.get(gaps, i)).alias("gap"), match.alias("match"),
                F.substring(F.get(gaps, i), -NEAR, NEAR).alias("left"),
                F.substring(F.get(gaps, i + 1), 1, NEAR).alias("right"),
            ),
        )

    none = F.array().cast("array<struct<kind:string,place:int,gap:int,match:string,left:string,right:string>>")
    arrays = [F.coalesce(F.when(F.size(f"{k}_gaps") > 1, hits(k, r)), none) for k, r in KINDS.items()]
    return stage(cut.select("row", "doc_id", F.concat(*arrays).alias("hits")), "hits")[0]


def find_spans(hits: DataFrame) -> DataFrame:
    """(row, kind, start, stop, match, left, right) of all valid matches in the rows of ``find_hits``.

    ``left`` and ``right`` are the ``NEAR`` characters beside a match, up to the next match of the kind.
    """
    # dealt by row, which serves the sums here and those of _without_overlap
    found = hits.select("row", F.explode("hits").alias("hit")).select("row", "hit.*").repartition("row")
    upto = Window.partitionBy("row", "kind").orderBy("place")
    length = F.length("match")
    start = F.sum("gap").over(upto) + F.sum(length).over(upto) - length
    return found.select(
        "row", "kind", start.alias("start"), (start + length).alias("stop"),
        F.translate("match", TIE + DOT, " .").alias("match"), "left", "right",
    ).filter(_valid(F.col("kind"), F.col("match")))


def _without_overlap(spans: DataFrame) -> DataFrame:
    """Base spans, and the candidates that share no character with one."""
    by_start = Window.partitionBy("row").orderBy("start", "stop")
    base = F.col("kind") != "id"
    before = F.max(F.when(base, F.col("stop"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce(before, F.lit(-1)) <= F.col("start")) & (F.coalesce(after, F.col("stop")) >= F.col("stop"))
    return spans.withColumn("_clear", base | clear).filter("_clear").drop("_clear")


def patterns(spans: DataFrame) -> DataFrame:
    """(pattern, instance, seed): the distinct edges between contexts and texts of spans."""
    lower = F.lower
    before = F.regexp_extract(lower("left"), r"([^\x20\x09-\x0D]*[\x20\x09-\x0D]*(?:[=:][\x20\x09-\x0D\"']*)?)$", 1)
    after = F.regexp_extract(lower("right"), r"^[\x20\x09-\x0D\"'.,;:!?)]*([^\x20\x09-\x0D]*)", 1)
    both = F.array(F.concat(F.lit("< "), F.trim(before)), F.concat(F.lit("> "), after))
    return spans.select(
        F.explode(both).alias("pattern"), F.md5(F.concat_ws(" ", "kind", "match")).alias("instance"),
        (F.col("kind") != "id").alias("seed"),
    ).distinct()


def score_instances(edges: DataFrame, accept: float = ACCEPT, rounds: int | None = None) -> DataFrame:
    """(instance, confidence) of those that are no seeds, after rounds over the graph.

    Confidences only grow, so rounds go on until one neither brings a trusted pattern to an
    instance that had none, nor an instance to ``accept``, nor adds ``STILL`` to the sum of all; or as
    many as said. A trusted pattern's unknown instances are fewer than two thirds of its
    sure ones, so what rounds add dwindles fast.

    Seeds stay at 1 and only count, and a pattern too small to be trusted, however sure its
    instances are, says nothing; so rounds go over the other edges alone, which carry what is
    known of both ends: one sum by pattern and one by instance a round.
    """
    totals = edges.groupBy("pattern").agg(F.count_if("seed").alias("seeds"), F.count("*").alias("n"))
    able = (F.col("n") >= SUPPORT) & (F.col("n") / (F.col("n") + SMOOTH) >= TRUSTED)
    links = edges.filter("not seed").select("pattern", "instance").join(totals.filter(able), "pattern")
    # one edge of each instance stands for it where instances are counted
    lead = links.groupBy("instance").agg(F.min("pattern").alias("lead"))
    links = links.join(lead, "instance").withColumn("lead", F.col("pattern") == F.col("lead"))
    links, _ = stage(links, "links")
    scored = links.withColumn("confidence", F.lit(0.0))
    was = None
    for _ in itertools.count() if rounds is None else range(rounds):
        trust = (F.first("seeds") + F.sum("confidence")) / (F.first("n") + SMOOTH)
        trusted = scored.groupBy("pattern").agg(trust.alias("trust")).filter(F.col("trust") >= TRUSTED)
        found = links.select("pattern", "instance").join(trusted, "pattern").groupBy("instance").agg(
            (1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999)))))).alias("confidence")
        )
        scored = links.join(found, "instance", "left").withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
        scored, _ = stage(scored, "confidence")
        sure, found = F.col("confidence"), scored.filter("lead and confidence > 0")
        number, accepted, total = found.agg(F.count("*"), F.count_if(sure >= accept), F.sum(sure)).first()
        now = (number, accepted, total or 0.0)
        if was and now[:2] == was[:2] and now[2] - was[2] < STILL:
            break
        was = now
    return scored.filter("lead and confidence > 0").select("instance", "confidence")


def extract(docs: DataFrame, rounds: int | None = None, accept: float = ACCEPT) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id) of all documents, and their spans (row, kind, start, stop, match)."""
    hits = find_hits(docs.select("doc_id", "text"))
    rows = hits.select("row", "doc_id")
    spans, _ = stage(_without_overlap(find_spans(hits)), "spans")
    edges, _ = stage(patterns(spans), "patterns")
    sure = score_instances(edges, accept, rounds).filter(F.col("confidence") >= accept)
    more = spans.filter("kind = 'id'").withColumn("instance", F.md5(F.concat_ws(" ", "kind", "match")))
    more = more.join(sure.select("instance"), "instance", "left_semi")
    columns = ["row", "kind", "start", "stop", "match"]
    return rows, spans.filter("kind != 'id'").select(*columns).unionByName(more.select(*columns))


def report(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, and all spans as text, base ones apart."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    lists = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct(order.alias("order"), "start", "stop", "kind"))).alias("found")
    )
    said = lambda items: F.array_join(
        F.transform(items, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))), ","
    )
    none = F.array().cast("array<struct<order:bigint,start:bigint,stop:bigint,kind:string>>")
    joined = rows.join(lists, "row", "left").withColumn("found", F.coalesce("found", none))
    base = F.filter("found", lambda s: s.kind != "id")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return joined.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
        said(F.col("found")).alias("spans"),
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_id, base_sha256, spans: one row per document."""
    return report(*extract(docs))
