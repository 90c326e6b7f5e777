"""Line dedup with a log-template tree. DataFrame functions only.

A line goes down a tree of fixed depth: first its token count, then its leading tokens, to a leaf. Tokens with a
digit are fields from the start. At a leaf, the positions that hold more than one token among its distinct lines are
fields too; where these are few, all lines of the leaf are one template. Else the leaf holds lines that only begin
alike, and is split by the tokens at the positions with the fewest different ones: first at one position, then at
four, at sixteen and so on, until each part is one template or a line of its own. So a stray line costs a template
nothing, however many lines share the leaf, and the rounds are no more than the logarithm of a line's length. Two
lines alone are less evidence than three: they may differ in half as many positions. A template that recurs in
enough documents is kept where it comes first and dropped elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HEAVY_SHARE, discard, heavy_keys, names_free, salted_join, stash

DEPTH = 2
MIN_TOKENS = 5
MIN_DOCS = 2
#: At most one position in so many may be a field of a template of three distinct lines or more, and of one of two.
FIELD_SHARE, PAIR_SHARE = 4, 8
#: The positions by which leaves are split are this many times more from round to round.
WIDER = 4
SPACES = r"[ \t\r\f\x0B]+"
#: A token with a digit; tried at token starts only and without backtracking, so long tokens cost no more.
FIELD = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"


def masked(line: Column) -> Column:
    """The line with single spaces and <*> for tokens with a digit."""
    return F.regexp_replace(F.trim(F.regexp_replace(line, SPACES, " ")), FIELD, "<*>")


def leaf_of(tokens: Column, depth: int) -> Column:
    """The tree's leaf: token count and leading tokens."""
    return F.xxhash64(F.size(tokens), F.array_join(F.slice(tokens, 1, depth), " "))


def mixed_leaves(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(leaf, template, tokens): the distinct lines of leaves that hold several, with hashes of their tokens.

    ``lines`` (doc_id, text_hash, pos, leaf, template). Of equal lines one is looked at; their texts are fetched once a
    document."""
    mixed = lines.groupBy("leaf").agg(F.min("template").alias("low"), F.max("template").alias("high")).where("low <> high").select("leaf")
    each = lines.join(mixed, "leaf", "left_semi").groupBy("leaf", "template").agg(F.min(F.struct("doc_id", "text_hash", "pos")).alias("at"))
    wanted = each.groupBy("at.doc_id", "at.text_hash").agg(F.collect_list(F.struct("at.pos", "leaf", "template")).alias("wanted"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines"))
    same = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["text_hash"] == wanted["text_hash"])
    found = rows.join(wanted, same).select(F.explode(F.transform("wanted", lambda w: F.struct(w["leaf"].alias("leaf"), w["template"].alias("template"), F.get(F.col("lines"), w["pos"]).alias("line")))).alias("x"))
    tokens = found.select("x.leaf", "x.template", F.transform(F.split(masked(F.col("x.line")), " "), lambda t: F.xxhash64(t)).alias("tokens"))
    return tokens.groupBy("leaf", "template").agg(F.any_value("tokens").alias("tokens"))  # rows of one document may repeat


def leaf_sizes(members: DataFrame) -> DataFrame:
    """(leaf, k, n, pair): distinct lines, tokens of each, and positions that differ between the first and the last line."""
    ends = members.groupBy("leaf").agg(F.count("*").alias("k"), F.min_by("tokens", "template").alias("low"), F.max_by("tokens", "template").alias("high"))
    differ = F.size(F.filter(F.zip_with("low", "high", lambda x, y: x != y), lambda d: d))
    return ends.select("leaf", "k", F.size("low").alias("n"), differ.alias("pair"))


def token_counts(members: DataFrame, leaves: DataFrame) -> DataFrame:
    """(leaf, at, d): how many different tokens the lines of ``leaves`` (leaf, k) have at a position, where more than one."""
    own = salted_join(members, leaves.select("leaf"), "leaf", F.xxhash64("template"), heavy_keys(leaves, "leaf", "k"))
    tokens = own.select("leaf", F.posexplode("tokens").alias("at", "token")).groupBy("leaf", "at", "token").agg(F.lit(1))
    return tokens.groupBy("leaf", "at").agg(F.count("*").alias("d")).where("d > 1")


def judged(sizes: DataFrame, counts: DataFrame) -> DataFrame:
    """(leaf, k, one): whether the lines of a leaf are one template."""
    fields = sizes.join(counts.groupBy("leaf").agg(F.count("*").alias("fields")), "leaf", "left")
    few = F.when(F.col("k") == 2, F.col("pair") * PAIR_SHARE <= F.col("n")).otherwise(F.col("fields") * FIELD_SHARE <= F.col("n"))
    return fields.select("leaf", "k", ((F.col("k") > 1) & few).alias("one"))


def split_leaves(members: DataFrame, leaves: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """``members`` of ``leaves`` (leaf, k), each in the part of its leaf that its tokens at the leaf's ``width`` positions with
    the fewest different tokens name (ties to the first position), where the part has another line."""
    ranked = counts.join(leaves.select("leaf"), "leaf").groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("d", "at"))).alias("ranked"))
    best = ranked.select("leaf", F.transform(F.slice("ranked", 1, width), lambda x: x["at"]).alias("places"))
    key = F.xxhash64("leaf", F.transform("places", lambda p: F.get(F.col("tokens"), p)))
    parts = stash(salted_join(members, best, "leaf", F.xxhash64("template"), heavy_keys(leaves, "leaf", "k")).select(key.alias("leaf"), "template", "tokens"), "parts")
    several = parts.groupBy("leaf").agg(F.count("*").alias("k")).where("k > 1")
    back = stash(salted_join(parts, several.select("leaf"), "leaf", F.xxhash64("template"), heavy_keys(several, "leaf", "k")), "members")
    discard(parts)
    return back


def shared_templates(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(template, shared): the lines that are one template with others, and its key."""
    members, width, out = stash(mixed_leaves(docs, lines), "members"), 1, []
    while True:
        sizes = stash(leaf_sizes(members), "sizes")
        counts = stash(token_counts(members, sizes.where("k > 2")), "counts")
        leaves = stash(judged(sizes, counts), "leaves")
        ones = leaves.where("one")
        key = F.unhex(F.md5(F.concat(F.lit(f"leaf {width} "), F.col("leaf").cast("string"))))
        settled = salted_join(members.select("leaf", "template"), ones.select("leaf"), "leaf", F.xxhash64("template"), heavy_keys(ones, "leaf", "k"))
        out.append(stash(settled.select("template", key.alias("shared")), "shared"))
        rest = leaves.where("not one and k > 2").select("leaf", "k")  # of two lines each part would be one line
        last = rest.isEmpty()
        after = None if last else split_leaves(members, rest, counts, width)
        for used in (members, sizes, counts, leaves):
            discard(used)
        if last:
            break
        members, width = after, width * WIDER
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    return whole


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, depth: int = DEPTH) -> DataFrame:
    """(doc_id, text_hash, drop): sorted 0-based line numbers to drop, for rows that lose any."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    split = rows.select("doc_id", "text_hash", "pos", masked(F.col("line")).alias("flat")).withColumn("tokens", F.split("flat", " "))
    own = F.when((F.col("flat") != "") & (F.size("tokens") >= min_tokens), F.struct(leaf_of(F.col("tokens"), depth).alias("leaf"), F.unhex(F.md5("flat")).alias("template")))
    # Written once, since several branches read it; filtered only then, or the filter would repeat the expressions.
    lines = stash(split.select("doc_id", "text_hash", "pos", own.alias("own")).select("doc_id", "text_hash", "pos", "own.*"), "lines").where("template is not null")
    frequent = F.col("n") > max(lines.count() // HEAVY_SHARE, 1)
    heavy = stash(lines.groupBy("template").agg(F.count("*").alias("n")).where(frequent).select("template"), "frequent")
    joined = salted_join(lines, shared_templates(docs, lines), "template", F.xxhash64("doc_id", "text_hash", "pos"), heavy, "left")
    keyed = stash(joined.select("doc_id", "text_hash", "pos", F.coalesce("shared", "template").alias("template")), "templates")
    discard(lines)
    first = F.min(F.struct("doc_id", "text_hash", "pos")).alias("first")
    in_docs = keyed.groupBy("template", "doc_id", "text_hash").agg(F.min("pos").alias("pos"), F.count("*").alias("rows"))
    recurring = stash(in_docs.groupBy("template").agg(F.count("*").alias("n"), F.sum("rows").alias("rows"), first).where(F.col("n") >= min_docs), "recurring")
    places = salted_join(keyed, recurring.select("template", "first"), "template", F.xxhash64("doc_id", "text_hash", "pos"), heavy_keys(recurring, "template", "rows"))
    lost = places.where(~F.struct("doc_id", "text_hash", "pos").eqNullSafe(F.col("first")))
    return lost.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("drop"))


def without(lines: Column, drop: Column) -> Column:
    """The elements of an array but those at the sorted positions, in time linear to both."""
    edges = F.concat(F.array(F.lit(-1)), drop, F.array(F.size(lines)))

    def pieces(x: Column) -> Column:  # one struct, so that neither array is made again for each piece
        edge = lambda i: F.element_at(x["edges"], i)
        return F.flatten(F.transform(F.sequence(F.lit(1), F.size(x["edges"]) - 1), lambda i: F.slice(x["lines"], edge(i) + 2, edge(i + 1) - edge(i) - 1)))

    return F.transform(F.array(F.struct(lines.alias("lines"), edges.alias("edges"))), pieces)[0]


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, depth: int = DEPTH) -> DataFrame:
    """``docs`` with the same columns and rows, ``text`` without recurring lines, and n_lines, n_dropped.

    A template counts for each document once; it recurs in ``min_docs`` documents or more, and then
    only its first line (smallest doc_id, then position) stays. Lines under ``min_tokens`` tokens never
    count. Null texts stay null with no lines, empty texts have one empty line; a null doc_id is a
    document of its own text that comes first; repeated rows are one document and are changed alike;
    line breaks between kept lines stay. A document may end up empty; no row is dropped.
    """
    key, flag, lost_doc, lost_hash, n_lines, n_dropped = names_free(docs, "text_hash", "drop", "lost_doc", "lost_hash", "n_lines", "n_dropped")
    lost = dropped_lines(docs.select("doc_id", "text"), min_docs, min_tokens, depth).select(F.col("doc_id").alias(lost_doc), F.col("text_hash").alias(lost_hash), F.col("drop").alias(flag))
    rows = docs.withColumn(key, F.xxhash64("text"))
    joined = rows.join(lost, rows["doc_id"].eqNullSafe(lost[lost_doc]) & (rows[key] == lost[lost_hash]), "left")
    lines = F.split("text", "\n")
    text = F.when(F.col(flag).isNull(), F.col("text")).otherwise(F.array_join(without(lines, F.col(flag)), "\n"))
    kept = [text.alias(c) if c.lower() == "text" else F.col(c) for c in docs.columns]
    count = lambda xs: F.greatest(F.coalesce(F.size(xs), F.lit(0)), F.lit(0)).cast("long")
    return joined.select(*kept, count(lines).alias(n_lines), count(flag).alias(n_dropped))


def oracle(min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, depth: int = DEPTH, rounds: int = 8) -> str:
    """SQL with the rounds written out; so many are enough for lines that differ at 4 ** (rounds - 1) positions."""
    flat = f"regexp_replace(trim(regexp_replace(line, '{SPACES}', ' ', 'g')), '[^ ]*[0-9][^ ]*', '<*>', 'g')"
    steps = "".join(f"""
places{i} AS MATERIALIZED (SELECT leaf, place, count(DISTINCT token) AS d FROM (SELECT leaf, unnest(ts) AS token, generate_subscripts(ts, 1) AS place FROM members{i}) GROUP BY leaf, place),
judged{i} AS MATERIALIZED (SELECT leaf, k, count(*) FILTER (d > 1) * CASE WHEN k = 2 THEN 8 ELSE 4 END <= count(*) AS one, list(place ORDER BY d, place) FILTER (d > 1) AS best
  FROM places{i} JOIN (SELECT leaf, count(*) AS k FROM members{i} GROUP BY leaf) USING (leaf) GROUP BY leaf, k),
members{i + 1} AS MATERIALIZED (SELECT leaf, ts FROM (SELECT *, count(*) OVER (PARTITION BY leaf) AS k FROM
  (SELECT md5(leaf || ' ' || array_to_string([ts[p] FOR p IN best[1:{4 ** i}]], ' ')) AS leaf, ts FROM members{i} JOIN judged{i} USING (leaf) WHERE NOT one AND k > 2)) WHERE k > 1),""" for i in range(rounds))
    shared = " UNION ALL ".join(f"SELECT ts, 'leaf {i} ' || leaf AS shared FROM members{i} JOIN judged{i} USING (leaf) WHERE one" for i in range(rounds))
    return f"""
WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, pos, line, {flat} AS flat FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM docs)),
counted AS MATERIALIZED (SELECT doc_id, pos, flat, string_split(flat, ' ') AS ts FROM lines WHERE flat <> '' AND len(string_split(flat, ' ')) >= {min_tokens}),
members0 AS MATERIALIZED (SELECT leaf, ts FROM (SELECT *, count(*) OVER (PARTITION BY leaf) AS k FROM
  (SELECT DISTINCT len(ts) || ' ' || array_to_string(ts[1:{depth}], ' ') AS leaf, ts FROM counted)) WHERE k > 1),{steps}
shared AS ({shared}),
keyed AS (SELECT c.doc_id, c.pos, coalesce(s.shared, 'line ' || c.flat) AS template FROM counted c LEFT JOIN shared s ON s.ts = c.ts),
recurring AS (SELECT template, count(DISTINCT doc_id) AS n, min((doc_id, pos)) AS first FROM keyed GROUP BY template HAVING n >= {min_docs}),
lost AS (SELECT c.doc_id, c.pos FROM keyed c JOIN recurring r USING (template) WHERE (c.doc_id, c.pos) <> r.first),
marked AS (SELECT l.doc_id, l.pos, l.line, x.pos IS NOT NULL AS gone FROM lines l LEFT JOIN lost x ON x.doc_id = l.doc_id AND x.pos = l.pos)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS text_sha256
FROM marked GROUP BY doc_id
"""
