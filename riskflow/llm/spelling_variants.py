"""Groups of spelling variants: words one edit apart, found by a frontier that walks tries level by level.

Every distinct word is spelled into two tries, one forwards and one backwards. A trie is kept as a table of
edges (node, label, child): a node is a prefix that words end at or branch at, a label what is read between two
nodes, so a chain without branches is one edge however long it is, and there are at most two edges for each word. The
frontier is a table of states (word, position, node, edits). In each round it is joined with the edges:

- a state without edits walks on along its word, and starts one with an edit on every other edge of its node: a replaced, an
  inserted or a deleted letter where the two part;
- a state with its edit goes on where the label is what comes next in its word.

A step is taken only to a child that has an edge for the word's next letter, or ends where the word does.
A state whose word and node both end, with one edit, is a pair of neighbours. Rounds go on until no state is left, so their number is
that of branches on a path, not the length of a word.

Edits start in the second half of a word only, in either trie: what two words have in common, at their beginning or at their end,
is at least half of one of them. This spares the top of the tries, where nodes have many children and all words meet. What both
tries would find is left to the forward one, so every neighbour of a word is found once.
Nodes are 64-bit hashes of prefixes; a pair is compared as text before it counts. A node that many words pass is a hot key of the join,
whose large side Spark divides (adaptive skew join).

A null or empty text has no runs. Equal words are one word, with the sum of their occurrences. An empty table gives no words.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LENGTH, MIN_COUNT, FACTOR = 6, 5, 5


def runs(docs: DataFrame, min_length: int = 1) -> DataFrame:
    """doc_id, run for each maximal run of letters with at least `min_length` code points, A-Z in lower case."""
    found = F.regexp_extract_all(F.col("text"), F.lit(RUN), F.lit(0))
    rows = docs.select("doc_id", F.explode(F.filter(found, lambda r: F.length(r) >= min_length)).alias("run"))
    ascii_only = F.octet_length("run") == F.length("run")
    lowered = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER))
    return rows.select("doc_id", lowered.alias("run"))


def misspelled(found: DataFrame, every: int = 199) -> DataFrame:
    """Runs of which one in `every`, by a hash of document and run, has lost a letter; a null doc_id counts as empty text."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    h = F.crc32(key.cast("binary"))
    gone = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), gone), F.substring(F.col("run"), gone + 2, F.length("run")))
    return found.withColumn("run", F.when(h % every == 0, cut).otherwise(F.col("run")))


def counted_words(found: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n for the runs that are long and frequent enough."""
    counts = found.where(F.length("run") >= min_length).groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


def _node(spelled: Column, depth: Column, trie: Column) -> Column:
    return F.xxhash64(trie, F.substring(spelled, F.lit(1), depth))


def _spelled(words: DataFrame) -> DataFrame:
    """Every word once for each trie: trie, spelled, size, half, id, word, n."""
    both = F.explode(F.array(F.struct(F.lit(0).alias("trie"), F.col("word").alias("spelled")), F.struct(F.lit(1).alias("trie"), F.reverse("word").alias("spelled"))))
    rows = words.select("id", "word", "n", both.alias("_s")).select("id", "word", "n", "_s.*")
    size = F.length("word")
    return rows.withColumns({"size": size, "half": F.floor(size / 2).cast("int")})


def _paths(spelled: DataFrame) -> DataFrame:
    """id, trie, nodes: depths of the nodes on each word's way, from the half of the shortest neighbour on, in order.

    A prefix is a node if two letters follow it or a word ends there; the end counts as a letter before all others.
    """
    depth = F.col("depth")
    prefixes = spelled.select("id", "trie", "spelled", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("size") - 1) / 2).cast("int")), "size")).alias("depth"))
    prefixes = prefixes.select("id", "trie", "depth", _node(F.col("spelled"), depth, F.col("trie")).alias("node"), F.substring(F.col("spelled"), depth + 1, F.lit(1)).alias("letter"))
    prefixes = materialize(prefixes, "prefixes")
    nodes = prefixes.groupBy("node").agg(F.min("letter").alias("low"), F.max("letter").alias("high"))
    nodes = nodes.where((F.col("low") != F.col("high")) | (F.col("low") == "")).select("node")
    return prefixes.join(nodes, "node").groupBy("id", "trie").agg(F.array_sort(F.collect_list("depth")).alias("nodes"))


def _edges(ways: DataFrame) -> DataFrame:
    """node, label, child, ends (a word ends at the child), least and most (size of words below), follow (letters that
    go on from the child) for each edge."""
    steps = F.arrays_zip(F.slice("nodes", F.lit(1), F.size("nodes") - 1).alias("up"), F.slice("nodes", F.lit(2), F.size("nodes") - 1).alias("down"))
    rows = ways.select("trie", "spelled", "size", F.explode(steps).alias("_s")).select("trie", "spelled", "size", "_s.*")
    label = F.substring(F.col("spelled"), F.col("up") + 1, F.col("down") - F.col("up"))
    rows = rows.select(
        _node(F.col("spelled"), F.col("up"), F.col("trie")).alias("node"),
        label.alias("label"),
        _node(F.col("spelled"), F.col("down"), F.col("trie")).alias("child"),
        (F.col("down") == F.col("size")).alias("ends"),
        "size",
    )
    rows = rows.groupBy("node", "label", "child").agg(F.max("ends").alias("ends"), F.min("size").alias("least"), F.max("size").alias("most"))
    rows = materialize(rows, "steps")
    letters = rows.groupBy(F.col("node").alias("child")).agg(F.array_join(F.sort_array(F.collect_set(F.left("label", F.lit(1)))), "").alias("follow"))
    return rows.join(letters, "child", "left").withColumn("follow", F.coalesce("follow", F.lit("")))


def _advance(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """One round: the states that follow from a frontier."""
    rest, label, at = F.col("spelled"), F.col("label"), F.col("at")
    long = F.length("label")
    piece = lambda start, n: F.substring(rest, at + start + 1, n)
    tail = F.substring(label, F.lit(2), long)
    state = lambda ok, move, edits: F.struct(ok.alias("ok"), (at + move).alias("at"), F.lit(edits).alias("edits"))
    size = F.col("size")

    def goes_to(goal: Column) -> Column:
        return (F.col("least") <= goal) & (F.col("most") >= goal)

    def alive(move: Column) -> Column:
        """Whether the child has an edge for the word's next letter, or ends where the word does."""
        letter = piece(move, F.lit(1))
        return F.when(letter == "", F.col("ends") & (at + move == size)).otherwise(F.instr(F.col("follow"), letter) > 0)

    fresh, same_letter = F.col("edits") == 0, F.left("label", F.lit(1)) == piece(0, F.lit(1))
    goes_on = piece(0, long) == label
    parts = fresh & ~same_letter & (at >= F.col("half"))
    # How far a state with an edit is from its node's depth says how long its neighbour is.
    cases = [
        (fresh & same_letter & goes_on & ((at + long < size) | (F.col("follow") != "")), long, 0),
        (~fresh & goes_to(F.col("goal")) & same_letter & goes_on & alive(long), long, 1),
        (parts & goes_to(size) & (piece(1, long - 1) == tail) & (at + long <= size) & alive(long), long, 1),
        (parts & goes_to(size + 1) & (piece(0, long - 1) == tail) & alive(long - 1), long - 1, 1),
        (parts & goes_to(size - 1) & (piece(1, long) == label) & alive(long + 1), long + 1, 1),
    ]
    options = F.array(*[state(*c) for c in cases])
    some = cases[0][0]
    for ok, _, _ in cases[1:]:
        some = some | ok
    shift = F.when(fresh, size + long - (F.col("next.at") - at)).otherwise(F.col("goal"))
    moved = frontier.drop("ends").join(edges, "node").where(some).withColumn("next", F.explode(F.filter(options, lambda s: s["ok"])))
    return moved.select(
        "id", "trie", "spelled", "size", "half", F.col("child").alias("node"), F.col("ends"),
        F.when(F.col("next.edits") == 1, shift).otherwise(size).alias("goal"), F.col("next.at").alias("at"), F.col("next.edits").alias("edits"),
    )


def _arrived(states: DataFrame) -> DataFrame:
    """States at the end of a neighbour: both end after one edit, or the word has just one letter more."""
    whole = (F.col("edits") == 1) & (F.col("at") == F.col("size"))
    longer = (F.col("edits") == 0) & (F.col("at") == F.col("size") - 1) & (F.col("at") >= F.col("half"))
    return states.where(F.col("ends") & (whole | longer)).select("id", "trie", "node")


def neighbours(words: DataFrame) -> DataFrame:
    """word, n, near, near_n for each ordered pair of words (word, n; words distinct) that are one edit apart."""
    words = materialize(words.select("word", "n"), "words").withColumn("id", F.monotonically_increasing_id())
    words = materialize(words, "numbered-words")
    spelled = _spelled(words)
    ways = materialize(spelled.join(_paths(spelled), ["id", "trie"]), "ways")
    edges = materialize(_edges(ways), "edges")
    second_half = F.filter("nodes", lambda d: d >= F.col("half"))
    start = ways.withColumn("at", F.get(second_half, F.lit(0)))
    node = _node(F.col("spelled"), F.col("at"), F.col("trie")).alias("node")
    # A word that ends where the search begins is one letter shorter; it is met as a child or here.
    ends = F.lit(True)
    states = start.select("id", "trie", "spelled", "size", "half", node, ends.alias("ends"), F.col("size").alias("goal"), "at", F.lit(0).alias("edits"))
    found = []
    while True:
        states = materialize(states, "frontier")
        if states.isEmpty():
            break
        found.append(_arrived(states))
        states = _advance(states, edges)
    ended = spelled.select(_node(F.col("spelled"), F.col("size"), F.col("trie")).alias("node"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = found[0] if found else states.where("false").select("id", "trie", "node")
    for more in found[1:]:
        pairs = pairs.union(more)
    pairs = pairs.join(ended, "node").join(words, "id")
    half = F.floor(F.length("word") / 2).cast("int")
    beginning = lambda c: F.substring(c, F.lit(1), half)
    own = (F.col("trie") == 0) | (beginning(F.col("word")) != beginning(F.col("near")))
    return pairs.where(own & (F.levenshtein("word", "near", 1) == 1)).select("word", "n", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: forms followed to the last, twice as far in each round."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = materialize(moved, "roots")
        roots = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return roots


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n for each of the words (word, n).

    The form is the near word with the largest n (ties: the first in code-point order) if that is at least `factor` times the word's;
    the root is where following forms ends, the word itself without a form. n grows along forms, so there are no circles.
    """
    words = materialize(words, "counted-words")
    # Counts lie in the pairs already; the largest is the least of (-n, word).
    best = neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("top"))
    named = words.join(best, "word", "left")
    is_form = -F.col("top.minus") >= factor * F.col("n")
    named = named.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("top.near")).alias("form"),
        F.when(is_form, -F.col("top.minus")).alias("form_n"),
    )
    named = materialize(named, "forms")
    roots = _roots(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
