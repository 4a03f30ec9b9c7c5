"""Spelling variants: words that differ in one letter, grouped under the most frequent one, by a trie's frontier.

The vocabulary becomes a table of edges of a path-compressed trie: (node, label, child), a node being the prefix that it
stands for. States (word, position, node, edits) start at the root and are joined with the edges level by level. Without
an edit a word walks its own path, and at each node the edges to other letters begin its one edit: a letter replaced,
inserted or deleted. After it the rest must match. An edit is always made where the two words first differ. States that
end with their word at another word are the neighbours.

Near the root a node has an edge for almost every letter, so that edits there would start a state each. Every word is
therefore in the trie twice, as it is and backwards, under different first letters: the first half of an edit's places is
taken by the backward word, the second half by the forward one, and both are deep in the trie, where few edges leave.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import documents, text_of, written

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One of so many runs loses a letter.
DAMAGED = 97
SHORTEST = 5
LEAST = 3
#: A form occurs so many times as often as the word at least.
OFTENER = 2
#: First letters of words that are read forwards and backwards.
FORWARD, BACKWARD = ">", "<"
#: Copies of the edges of nodes with up to `SHALLOW` letters, over which the states there, of whole parts of the vocabulary, are spread.
SPREAD = 32
SHALLOW = 3


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, one in `DAMAGED` of them without one of its letters."""
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text_of(text), F.lit(f"({RUN})"), F.lit(1))).alias("run"),
    ).where(F.length("run") >= shortest)
    # most runs have no capitals, and `translate` looks up every letter
    runs = runs.select("id", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(F.col("h") % DAMAGED == 0, less).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least)


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _common_of(a: Column, b: Column) -> Column:
    @F.pandas_udf("int")
    def common(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_common(x, y) for x, y in zip(a, b)], dtype="int32")

    return common(a, b)


def _after_previous(rows: DataFrame, column: str, label: str) -> DataFrame:
    """`rows` of distinct strings with `shared`: how many letters each has in common with the next smaller one.

    Rows are dealt by ranges. Only a range's first row needs the range before, of which one row is kept.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(rows.repartitionByRange(n, column).withColumn("part", F.spark_partition_id()), f"{label}-ranges")
    last = dealt.groupBy("part").agg(F.max(column).alias("last"))
    before = last.select("part", F.lag("last").over(Window.orderBy("part")).alias("before"))
    inside = dealt.withColumn("previous", F.lag(column).over(Window.partitionBy("part").orderBy(column)))
    firsts = inside.where("previous IS NULL").join(before, "part").withColumn("previous", F.coalesce("before", F.lit(""))).drop("before")
    both = inside.where("previous IS NOT NULL").unionByName(firsts)
    return both.withColumn("shared", _common_of(F.col("previous"), F.col(column))).drop("part", "previous")


def trie(words: DataFrame) -> DataFrame:
    """(node, salt, first, label, child, terminal, after): the edges of a path-compressed trie of the distinct `word`s.

    `first` is the label's first letter, `terminal` tells whether the child is a word, and `after` holds the first
    letters of the child's own edges, which are as many as the alphabet has at most. Nodes near the root, where states
    of many words meet, have each edge `SPREAD` times, under different salts.
    """
    prefixes = _after_previous(words.select("word"), "word", "trie-words")
    parts = F.array(
        F.struct(F.col("word").alias("node"), F.lit(True).alias("terminal")),
        F.struct(F.substr("word", F.lit(1), F.col("shared")).alias("node"), F.lit(False).alias("terminal")),
    )
    nodes = prefixes.select(F.explode(parts).alias("x")).groupBy(F.col("x.node").alias("node")).agg(F.max("x.terminal").alias("terminal"))
    ordered = _after_previous(nodes.where("node <> ''"), "node", "trie-nodes")
    edges = ordered.select(
        F.substr("node", F.lit(1), F.col("shared")).alias("parent"),
        F.substr("node", F.col("shared") + 1).alias("label"),
        F.col("node").alias("child"),
        "terminal",
    ).withColumn("first", F.substr("label", F.lit(1), F.lit(1)))
    edges = written(edges, "trie-edges")
    onward = edges.groupBy(F.col("parent").alias("child")).agg(F.array_join(F.sort_array(F.collect_list("first")), "").alias("after"))
    salts = F.when(F.length("parent") <= SHALLOW, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    out = edges.join(onward, "child", "left").select(
        F.col("parent").alias("node"), F.explode(salts).alias("salt"), "first", "label", "child", "terminal", F.coalesce("after", F.lit("")).alias("after")
    )
    return written(out, "trie")


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states that one edge further on can still come to something, with `near`: whether the child is a neighbour of
    the word, and `alive`: whether the state can go on. A word is edited at positions from `free` on."""
    salt = F.when(F.length("node") <= SHALLOW, F.pmod(F.xxhash64("word"), F.lit(SPREAD)).cast("int")).otherwise(F.lit(0))
    states = states.withColumn("salt", salt).withColumn("here", F.substr("word", F.col("at") + 1, F.lit(1)))
    size, left = F.length("label"), F.length("word") - F.col("at")
    tail = F.substr("label", F.lit(2))

    def rest(skip: int, length: Column) -> Column:
        return F.substr("word", F.col("at") + 1 + skip, length)

    exact = F.col("first") == F.col("here")
    to = F.col("at") + size

    def reached(at: Column, edits: int) -> Column:
        """The state at the child, null where nothing can come of it."""
        ahead = F.length("word") - at
        near = F.col("terminal") & (ahead == 1 - edits)
        onward = F.col("after") != ""
        if edits:
            onward = (ahead > 0) & F.col("after").contains(F.substr("word", at + 1, F.lit(1)))
        return F.when(near | onward, F.struct(at.alias("at"), F.lit(edits).alias("edits"), near.alias("near"), onward.alias("alive")))

    moves = F.array(
        F.when(exact, reached(to, 0)),
        F.when(~exact & (left > 0) & (rest(1, size - 1) == tail), reached(to, 1)),
        F.when(~exact & (rest(0, size - 1) == tail), reached(to - 1, 1)),
        F.when(~exact & (left > 0) & (rest(1, size) == F.col("label")), reached(to + 1, 1)),
    )
    edges = edges.hint("shuffle_hash")  # a task's edges are few beside its states
    open_ = (F.col("edits") == 0) & (F.col("at") >= F.col("free"))
    branching = states.where(open_).join(edges, ["node", "salt"]).select("word", "free", "child", F.explode(moves).alias("move"))
    straight = states.where(~open_).withColumnRenamed("here", "first").join(edges, ["node", "salt", "first"])
    onward = F.when(F.col("edits") == 0, reached(to, 0)).otherwise(reached(to, 1))
    straight = straight.where(rest(0, size) == F.col("label")).select("word", "free", "child", onward.alias("move"))
    found = branching.unionByName(straight).where("move IS NOT NULL")
    return found.select("word", "free", "move.at", F.col("child").alias("node"), "move.edits", "move.near", "move.alive")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near): all ordered pairs of the distinct, non-empty `word`s that one inserted, deleted or replaced letter tells apart.

    A round of joins for each level of the trie, whose depth is the most nodes on a path: places where words part, and
    words that begin other words. Each round's states are written. A pair is found forwards if the words have the first
    half of `word` in common, and backwards if not.
    """
    half = F.floor(F.length("word") / 2).cast("int")
    both = words.select(
        F.explode(
            F.array(
                F.struct(F.concat(F.lit(FORWARD), "word").alias("word"), (half + 1).alias("free")),
                F.struct(F.concat(F.lit(BACKWARD), F.reverse("word")).alias("word"), (F.length("word") - half + 1).alias("free")),
            )
        ).alias("x")
    ).select("x.*")
    both = written(both, "trie-both")
    edges = trie(both)
    states = both.select("word", "free", F.lit(0).alias("at"), F.lit("").alias("node"), F.lit(0).alias("edits"))
    found = []
    while True:
        level = written(_step(states, edges), "frontier")
        found.append(level.where("near").select("word", F.col("node").alias("near")))
        states = level.where("alive").select("word", "free", "at", "node", "edits")
        if states.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    forward = F.col("word").startswith(FORWARD)
    plain = [F.substr(c, F.lit(2)) for c in ("word", "near")]
    out = out.select(forward.alias("forward"), *(F.when(forward, x).otherwise(F.reverse(x)).alias(c) for c, x in zip(("word", "near"), plain)))
    first = [F.substr(c, F.lit(1), half) for c in ("word", "near")]
    return out.where(F.col("forward") | (first[0] != first[1])).select("word", "near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the links (word, form) end, links being doubled until none goes on. There are no circles."""
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = state.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = written(moved, "roots")
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, oftener: int = OFTENER
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word of `shortest` letters and `least` occurrences at least.

    `form` is the neighbour that occurs most (then the smallest), if it occurs `oftener` times as often as the word,
    else null; `root` is where forms lead. Null texts have no words; a null id counts as an empty one in the choice of
    the runs that lose a letter. Repeated rows count each time. Empty tables give no rows; other columns are not read.
    """
    words = written(word_counts(docs, doc_id, text, shortest, least), "words")
    pairs = neighbours(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    chosen = words.join(pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")), "word", "left")
    good = -F.col("best.less") >= oftener * F.col("n")
    chosen = written(
        chosen.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(chosen.where("form IS NOT NULL"))
    return chosen.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    """Whole `documents`."""
    return variants(documents(spark, sf_dir))


OP12_SQL = f"""
WITH RECURSIVE steps AS (
  SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
t AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run
  FROM documents),
counts AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= {SHORTEST} GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END))),
    lambda a, b: xor(a >> 8, t.t[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM counts, t),
made AS (
  SELECT CASE WHEN h % {DAMAGED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {LEAST}),
gaps AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.less = b.word),
placed AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS o, count(*) OVER (PARTITION BY word) AS n_near FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(p.n_near, 0) AS n_near, CASE WHEN near_n >= {OFTENER} * w.n THEN near END AS form,
         CASE WHEN near_n >= {OFTENER} * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN placed p ON p.word = w.word AND o = 1),
chain AS (
  SELECT word, word AS root, form AS next, 0 AS depth FROM formed
  UNION ALL SELECT c.word, f.word, f.form, depth + 1 FROM chain c JOIN formed f ON f.word = c.next),
ends AS (SELECT word, root FROM chain WHERE next IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
