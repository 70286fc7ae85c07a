"""Which of many topic patterns match each routing key, by a trie walked level by level.

Patterns share the nodes of their common beginnings. Each distinct topic keeps the nodes it has reached;
a word leads on by equality joins with the edges of that word and of ``*``, while ``#`` may stay
where it is. So no topic is compared with a pattern that differs in its first words, and a
pattern in a million bindings is walked once.

``*`` is one word and ``#`` any number of words, none of them empty; ``#`` alone matches every topic.
Null topics and null patterns match nothing; repeated bindings are each returned.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.functions.joins import fits_broadcast, lookup_join
from opsledger.functions.workspace import stored

ONE, MANY = "*", "#"
_ROOT = ""


def _trie(patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (node, label, next) and ends (node, pattern). A node is named by the words to it."""
    # "#.#" is "#"
    words = F.split("pattern", r"\.")
    keep = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("w"), ((w == MANY) & (F.get(words, i - 1) == MANY)).alias("again"))),
        lambda s: ~F.coalesce(s["again"], F.lit(False)),
    )
    rows = patterns.select("pattern", F.transform(keep, lambda s: s["w"]).alias("words"))
    path = lambda n: F.concat_ws(".", F.lit("~"), F.array_join(F.slice("words", 1, n), "."))
    name = lambda n: F.when(n == 0, _ROOT).otherwise(path(n))
    steps = rows.select("pattern", "words", F.posexplode("words").alias("at", "label"))
    edges = steps.select(name(F.col("at")).alias("node"), "label", path(F.col("at") + 1).alias("next")).distinct()
    ends = rows.select(path(F.size("words")).alias("node"), "pattern")
    return stored(edges, "topic-edges"), stored(ends, "topic-ends")


def _with_loops(reached: DataFrame, edges: DataFrame, is_small: bool) -> DataFrame:
    """Nodes, and those that a ``#`` leads to without a word."""
    loops = edges.where(F.col("label") == MANY).select("node", F.col("next").alias("loop"))
    more = lookup_join(reached, loops, ["node"], is_small=is_small)
    looped = more.select("topic", "words", F.col("loop").alias("node"), F.lit(True).alias("stays"))
    return reached.unionByName(looped)


def matching_patterns(topics: DataFrame, patterns: DataFrame) -> DataFrame:
    """(topic, pattern) for the distinct ``topic`` and distinct ``pattern`` values."""
    known = stored(patterns.select("pattern").where("pattern IS NOT NULL").distinct(), "topic-patterns")
    every = F.regexp_count("pattern", F.lit(r"^#(\.#)*$")) > 0
    edges, ends = _trie(known.where(~every))
    is_small = fits_broadcast(edges)
    distinct = stored(topics.select("topic").where("topic IS NOT NULL").distinct(), "topic-keys")
    words = F.split("topic", r"\.", -1)
    longest = distinct.agg(F.max(F.size(words))).first()[0] or 0
    state = distinct.select("topic", words.alias("words"), F.lit(_ROOT).alias("node"), F.lit(False).alias("stays"))
    state, found = _with_loops(state, edges, is_small), []
    for at in range(longest):
        word = F.get("words", F.lit(at))
        left = state.where(F.size("words") > at)
        full = word != ""
        labels = F.when(full, F.array_distinct(F.array(word, F.lit(ONE)))).otherwise(F.array(word))
        asked = left.withColumn("label", F.explode(labels))
        moved = lookup_join(asked, edges.where(F.col("label") != MANY), ["node", "label"], is_small=is_small)
        moved = moved.select("topic", "words", F.col("next").alias("node"), F.lit(False).alias("stays"))
        stayed = left.where(F.col("stays") & full)
        state = stored(_with_loops(moved, edges, is_small).unionByName(stayed).distinct(), "topic-state")
        found.append(state.where(F.size("words") == at + 1).select("topic", "node").distinct())
    out = None
    for reached in found:
        hits = lookup_join(reached, ends, ["node"], is_small=is_small).select("topic", "pattern")
        out = hits if out is None else out.unionByName(hits)
    # patterns of "#" alone match every topic; there is one for each number of "#" at most
    always = [F.lit(r["pattern"]) for r in known.where(every).collect()]
    if always:
        pairs = distinct.select("topic", F.explode(F.array(*always)).alias("pattern"))
        out = pairs if out is None else out.unionByName(pairs)
    return out if out is not None else distinct.select("topic", F.lit("").alias("pattern")).limit(0)


def subscribed(messages: DataFrame, bindings: DataFrame, topic: str = "topic", pattern: str = "pattern") -> DataFrame:
    """Each message with each binding whose pattern matches its topic."""
    pairs = stored(
        matching_patterns(
            messages.select(F.col(topic).alias("topic")), bindings.select(F.col(pattern).alias("pattern"))
        ),
        "topic-pairs",
    )
    named = pairs.select(F.col("topic").alias(topic), F.col("pattern").alias(pattern))
    wanted = lookup_join(named, bindings, [pattern])
    return lookup_join(messages, wanted, [topic])
