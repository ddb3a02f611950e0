"""Mix sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

The words of a shard (a hash share of a source, of bounded size) lie end to end in a seeded order and are cut into blocks
of equal size, smaller ones in small sources, down to single words. Words go to sources, and a source's blocks to its shards,
by the highest quotients share / (2k - 1). A shard then takes each of its blocks as often as its quota divides, and the rest
once more, in the order of a seeded hash.
Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cdcframe.llm.common import cut, row_key

WORD = r"[^\x20\x09-\x0D]+"
TIMES = 3
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 20
#: A source has at least so many blocks, if it has as many words.
LEAST_BLOCKS = 64


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _digest(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *(F.coalesce(part.cast("string"), F.lit("")) for part in parts)))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), times: int = TIMES) -> DataFrame:
    """One row per `source` of `sizes` (`source`, `size`): `place`, `source_size`, `target`.

    Sources in code point order, NULL last, have the weights in turn. The targets share the sum of all sizes; one that
    would exceed `times` its source's size stops there, and the others share the rest by weight.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).cast("int")
    turn = F.array(*(F.lit(w).cast("long") for w in weights))
    ranked = per_source.withColumn("place", order).withColumn("weight", turn[(F.col("place") - 1) % len(weights)])
    cap = F.col("source_size") * times
    # With sources by cap for their weight, the level at which the rest of them share is largest where the caps end.
    first = W.orderBy(cap / F.col("weight"), "place")
    before = first.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = ranked.withColumn("level", left / weight)
    target = F.least(cap.cast("double"), F.col("weight") * F.max("level").over(every))
    return levels.select("place", "source", "source_size", target.alias("target"))


def sainte_lague(parties: DataFrame, group: list[str], party: str, votes: str, seats: str) -> DataFrame:
    """`parties` with `quota`: the `seats` of each group, given to its parties one by one by the highest votes / (2k - 1).

    Ties go to the smaller `party`. All divisors that give `seats` lie within half a seat per party of the even one, so
    only the quotients in that reach are ranked: about three per party, however many the seats.
    """
    all_votes = F.sum(votes).over(W.partitionBy(*group))
    n = F.count("*").over(W.partitionBy(*group))
    share = F.when(all_votes > 0, F.col(votes) / all_votes).otherwise(F.lit(0.0))
    ideal, reach = share * F.col(seats), share * n / 2 + 1
    bounded = parties.withColumns(
        {
            "low": F.greatest(F.lit(0).cast("long"), F.floor(ideal - reach)),
            "high": F.when(share > 0, F.ceil(ideal + reach)).otherwise(F.lit(0).cast("long")),
        }
    ).withColumn("rest", F.col(seats) - F.sum("low").over(W.partitionBy(*group)))
    ks = F.when(F.col("high") > F.col("low"), F.sequence(F.col("low") + 1, F.col("high")))
    ranked = bounded.select("*", F.explode_outer(ks).alias("k")).withColumn(
        "rank",
        F.row_number().over(
            W.partitionBy(*group).orderBy(
                F.col("k").isNull(), (F.col(votes) / (2 * F.col("k") - 1)).desc(), party, "k"
            )
        ),
    )
    given = F.sum(((F.col("rank") <= F.col("rest")) & F.col("k").isNotNull()).cast("long"))
    return ranked.groupBy(*parties.columns, "low").agg(given.alias("given")).select(
        *parties.columns, (F.col("low") + F.col("given")).alias("quota")
    )


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    times: int = TIMES,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 0,
) -> DataFrame:
    """Which words of which row the mix takes.

    A row for each piece of a row of `docs`: the id, `key` (of id and text), `size`, `source_size`, `target`, `n`
    (numbers the rows of a shard, so that (`place`, `shard`, `n`) is a row of `docs`), `start` and `end` of the piece in
    words, and `copies`, how often it is taken: 0 to `times`. A row without words has one piece with NULL bounds. NULL is
    a source like any other. Repeated rows are rows of their own. The result depends on ids, texts, sources and the seed
    only, so reruns agree. Other columns are not carried.
    """
    # The text is read once; all that follows is about these narrow rows.
    rows = cut(
        docs.select(
            F.col(id).alias("id"),
            F.col(source).alias("source"),
            _digest(seed, F.col(id), F.md5(F.col(text).cast("binary"))).alias("order"),
            row_key(id, text).alias("key"),
            n_words(text).alias("size"),
        )
    )
    sources = targets(rows, weights, times)
    # Words to sources: as many as all sources have.
    sources = sources.withColumn("words", F.sum("source_size").over(W.partitionBy()).cast("long"))
    sources = sainte_lague(sources, [], "place", "target", "words").withColumnRenamed("quota", "source_words")
    sources = sources.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)))
    even = F.floor(F.col("source_size") / LEAST_BLOCKS)
    sources = sources.withColumn("block_words", F.greatest(F.lit(1).cast("long"), F.least(F.lit(block_words).cast("long"), even)))
    sources = cut(sources.drop("words"))

    named = sources.withColumnRenamed("source", "name")
    placed = rows.join(named, rows["source"].eqNullSafe(named["name"])).drop("name", "source")
    hashed = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    placed = placed.withColumn("shard", hashed % F.col("shards"))
    shards = placed.groupBy("place", "shard", "source_words", "source_size", "block_words").agg(F.sum("size").alias("shard_size"))
    blocks = F.greatest(F.lit(1).cast("long"), F.floor(F.col("shard_size") / F.col("block_words") + 0.5))
    shards = shards.withColumn("n_blocks", F.when(F.col("shard_size") > 0, blocks).otherwise(F.lit(0).cast("long")))
    # The source's words in blocks of its shards. No more than `times` of them all, so no shard gets more of its own: the
    # quotient of one more than that is below every other shard's last within it.
    every = F.sum("n_blocks").over(W.partitionBy("place"))
    share = F.when(F.col("source_size") > 0, F.floor(F.col("source_words") / F.col("source_size") * every + 0.5))
    shards = shards.withColumn("seats", F.least(F.coalesce(share, F.lit(0)).cast("long"), every * times))
    shards = sainte_lague(shards, ["place"], "shard", "n_blocks", "seats")
    shards = shards.select("place", "shard", "shard_size", "n_blocks", "quota")

    shard = W.partitionBy("place", "shard")
    lined = placed.join(shards, ["place", "shard"]).withColumns(
        {
            "n": F.row_number().over(shard.orderBy("order", "id", "size")),
            "end": F.sum("size").over(shard.orderBy("order", "id", "size").rowsBetween(W.unboundedPreceding, 0)),
        }
    )
    begin = F.col("end") - F.col("size")

    # Block i starts at word floor(i * shard_size / n_blocks).
    pieces = lined.withColumn("begin", begin).select(
        "*",
        F.expr(
            "explode_outer(if(size > 0, sequence(((begin + 1) * n_blocks - 1) div shard_size,"
            " (end * n_blocks - 1) div shard_size), null)) as block"
        ),
    )
    edges = {"lo": F.expr("block * shard_size div n_blocks"), "hi": F.expr("(block + 1) * shard_size div n_blocks")}
    drawn = F.dense_rank().over(
        shard.orderBy(F.col("block").isNull(), _digest(seed, F.col("place"), F.col("shard"), F.col("block")), "block")
    )
    copies = F.expr("quota div n_blocks") + (drawn <= F.col("quota") % F.col("n_blocks")).cast("long")
    return pieces.withColumns(edges).select(
        F.col("id").alias(id), "key", "size", "source_size", "target", "place", "shard", "n",
        (F.greatest(F.col("begin"), F.col("lo")) - F.col("begin")).alias("start"),
        (F.least(F.col("end"), F.col("hi")) - F.col("begin")).alias("end"),
        F.when(F.col("block").isNotNull(), copies).otherwise(F.lit(0).cast("long")).alias("copies"),
    )


def taken(pieces: DataFrame, id: str = "doc_id") -> DataFrame:
    """One row per row of the mixed table: the id, `size`, `source_size`, `target` and `taken`, its words with repeats."""
    words = F.coalesce(F.sum((F.col("end") - F.col("start")) * F.col("copies")), F.lit(0).cast("long"))
    return (
        pieces.groupBy("place", "shard", "n", id, "size", "source_size", "target")
        .agg(words.alias("taken"))
        .select(id, "size", "source_size", "target", "taken")
    )


def mixed_texts(docs: DataFrame, pieces: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` as the mix takes them: the same columns, the text cut to the words taken, repeats as rows.

    The k-th copy of a row holds the words that are taken k times or more, each with the white space after it.
    """
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    spans = (
        pieces.filter((F.col("copies") > 0) & F.col("start").isNotNull())
        .select(F.col("key").alias("_mix_key"), "size", "place", "shard", "n", F.struct("start", "end").alias("span"), copy)
        .groupBy("_mix_key", "size", "place", "shard", "n", "copy")
        .agg(
            F.sort_array(F.collect_list("span")).alias("_mix_spans"),
            (F.sum(F.col("span.end") - F.col("span.start")) == F.col("size")).alias("_mix_whole"),
        )
        .select("_mix_key", "_mix_spans", "_mix_whole")
    )
    # Rows with the same id and text are one here; each of their copies comes back through its own spans.
    keyed = docs.withColumn("_mix_key", row_key(id, text)).dropDuplicates(["_mix_key"])
    words = F.regexp_extract_all(F.col(text), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    part = F.flatten(F.transform("_mix_spans", lambda s: F.slice("_mix_words", s["start"] + 1, s["end"] - s["start"])))
    joined = keyed.join(spans, "_mix_key").withColumn("_mix_words", F.when(~F.col("_mix_whole"), words))
    taken_text = F.when(F.col("_mix_whole"), F.col(text)).otherwise(F.array_join(part, ""))
    return joined.withColumn(text, taken_text).select(*docs.columns)


SQL = f"""
with sizes as (
  select doc_id, source, coalesce(md5(text), '') as digest,
    coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0b\\f\\r]+')), 0)::bigint as size
  from documents),
rows_ as (
  select doc_id, source, size, md5('0:' || coalesce(doc_id::varchar, '') || ':' || digest) as ord,
    row_number() over () as row_id from sizes),
ranked as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source asc nulls last) as place
  from rows_ group by source),
weighed as (select *, (place - 1) % 3 + 1 as weight from ranked),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(3 * source_size) over w, 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over w, 0))::double as level
  from weighed
  window w as (order by (3 * source_size)::double / weight, place rows between unbounded preceding and 1 preceding)),
goals as (
  select place, source, source_size, least((3 * source_size)::double, weight * max(level) over ()) as target,
    (sum(source_size) over ())::bigint as all_words,
    greatest(1, least({BLOCK_WORDS}, source_size // {LEAST_BLOCKS}))::bigint as block_words from levels),
seats as (
  select place, row_number() over (order by target / (2 * k - 1) desc, place, k) as rank, all_words
  from (select *, unnest(range(1, least(all_words, 3 * source_size + 2) + 1)) as k from goals where target > 0)),
quotas as (select place, count(*) as quota from seats where rank <= all_words group by place),
sourced as (
  select g.*, coalesce(q.quota, 0) as source_words, greatest(1, ceil(source_size::double / {SHARD_WORDS}))::bigint as shards
  from goals g left join quotas q using (place)),
placed as (
  select r.doc_id, r.size, r.ord, r.row_id, s.place, s.source_size, s.target, s.source_words, s.block_words,
    ('0x' || substr(r.ord, 1, 8))::bigint % s.shards as shard
  from rows_ r join sourced s on r.source is not distinct from s.source),
sized as (
  select place, shard, source_words, source_size, block_words, sum(size)::bigint as shard_size from placed group by all),
shards as (
  select *, case when shard_size > 0 then greatest(1, floor(shard_size::double / block_words + 0.5)) else 0 end::bigint as n_blocks
  from sized),
wanted as (
  select *, least(case when source_size > 0 then
      floor(source_words::double / source_size * (sum(n_blocks) over (partition by place))::double + 0.5) else 0 end,
    3 * sum(n_blocks) over (partition by place))::bigint as seats from shards),
shard_seats as (
  select place, shard, seats, row_number() over (partition by place order by n_blocks::double / (2 * k - 1) desc, shard, k) as rank
  from (select *, unnest(range(1, seats + 1)) as k from wanted where n_blocks > 0)),
shard_quotas as (select place, shard, count(*) as shard_quota from shard_seats where rank <= seats group by all),
cut_ as (
  select s.place, s.shard, s.shard_size, s.n_blocks, coalesce(q.shard_quota, 0) as shard_quota
  from shards s left join shard_quotas q using (place, shard)),
lined as (
  select p.*, c.shard_size, c.n_blocks, c.shard_quota,
    sum(size) over (partition by place, shard order by ord, doc_id nulls first, size, row_id)::bigint as stop
  from placed p join cut_ c using (place, shard)),
blocks_ as (
  select place, shard, shard_quota, n_blocks, unnest(range(0, n_blocks)) as block,
    block * shard_size // n_blocks as lo, (block + 1) * shard_size // n_blocks as hi from cut_),
drawn as (
  select *, shard_quota // n_blocks + (row_number() over (partition by place, shard
      order by md5('0:' || place || ':' || shard || ':' || block), block) <= shard_quota % n_blocks)::bigint as copies
  from blocks_),
words as (
  select l.row_id, sum((least(l.stop, b.hi) - greatest(l.stop - l.size, b.lo)) * b.copies)::bigint as taken
  from lined l join drawn b on l.place = b.place and l.shard = b.shard and b.lo < l.stop and b.hi > l.stop - l.size
  group by all)
select l.doc_id, l.size, l.source_size, l.target, coalesce(w.taken, 0)::bigint as taken
from lined l left join words w using (row_id)
"""
