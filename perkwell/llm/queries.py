"""The named queries of this package and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from perkwell.llm import (
    decontamination, fill_in_middle, mixing, near_duplicates, pii, quality, quotations, repeated_bytes, spotsigs, token_counts, toxicity,
    url_lists, vector_codes,
)
from perkwell.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


MIX = mixing.Mix()


@query
def op1_mixing(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mix_plan(table(spark, directory, "documents"), MIX)


@query
def op2_near_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    return near_duplicates.near_duplicate_classes(table(spark, directory, "documents"))


@query
def op3_pii(spark: SparkSession, directory: str) -> DataFrame:
    found = pii.find_spans(table(spark, directory, "documents"))
    return found.select("doc_id", *[pii.count_of(kind).alias(f"n_{kind}") for kind in pii.PATTERNS], F.sha2(pii.listed("_base"), 256).alias("base_sha256"), pii.listed("_spans").alias("spans"))


@query
def op4_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    return spotsigs.edit_report(table(spark, directory, "documents"))


def page_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures: the day of the fetch follows from the page id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366 * 7919 % 366).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))


def _digit(text: F.Column, place: int) -> F.Column:
    return F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(text), place, 1)) - 1


def host_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts seen: which of them, since when and until when follows from the host's hash."""
    host = pages.select(url_lists.host_of(F.col("url")).alias("host")).filter("host <> ''").distinct()
    h = F.col("host")

    def entry(key: F.Column, action: str, day: F.Column) -> F.Column:
        since = F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int"))
        return F.struct(key.alias("key"), F.lit(action).alias("action"), since.alias("since"))

    first = _digit(h, 1) * 12
    log = F.when(F.rlike(h, F.lit("spam|pills")), F.array(
        entry(h, "block", F.lit(0)), entry(h, "remove", F.lit(300)),
    )).when(_digit(h, 2) < 6, F.array(
        entry(h, "block", first), entry(h, "remove", first + 40), entry(h, "block", first + 90),
        entry(F.concat(h, F.lit("/en")), "allow", first + 20),
    )).when(_digit(h, 2) < 9, F.array(
        entry(F.regexp_replace(h, r"^[^.]*\.", ""), "block", first + 30),
        entry(F.regexp_replace(h, r"^[^.]*\.", ""), "remove", first + 60),
        entry(h, "allow", first + 50),
    ))
    return host.select(F.explode(log).alias("e")).select("e.*")


@query
def op5_url_lists(spark: SparkSession, directory: str) -> DataFrame:
    pages = table(spark, directory, "pages")
    out = url_lists.evaluate(page_captures(pages), host_entries(pages))
    return out.withColumn("fetched", F.col("fetched").cast("string")).withColumn("listed_since", F.col("listed_since").cast("string"))


@query
def op6_repeated_bytes(spark: SparkSession, directory: str) -> DataFrame:
    out = repeated_bytes.remove_repeated(table(spark, directory, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select(
        "doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op7_quality(spark: SparkSession, directory: str) -> DataFrame:
    return quality.scored(table(spark, directory, "documents"), table(spark, directory, "labels"))


@query
def op8_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.scored(table(spark, directory, "documents"), table(spark, directory, "labels"))


@query
def op9_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return decontamination.contained_items(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


def quoting_messages(conversations: DataFrame) -> DataFrame:
    """The conversations as mail: two of three replies quote the message before, and some of these what it quoted."""
    plain = conversations.select("conv_id", "turn", "text")

    def quoted(mark: str) -> F.Column:
        return F.concat(F.lit(mark), F.regexp_replace(F.coalesce("text", F.lit("")), "\n", f"\n{mark}"), F.lit("\n"))

    before = plain.select("conv_id", (F.col("turn") + 1).alias("turn"), quoted("> ").alias("_one"))
    earlier = plain.select("conv_id", (F.col("turn") + 2).alias("turn"), quoted(">> ").alias("_two"))
    kind = (F.col("conv_id") + F.col("turn")) % 3
    joined = conversations.join(before, ["conv_id", "turn"], "left").join(earlier, ["conv_id", "turn"], "left")
    quotes = F.when(kind == 1, F.coalesce("_one", F.lit(""))).when(
        kind == 2, F.concat(F.coalesce("_two", F.lit("")), F.coalesce("_one", F.lit("")))
    ).otherwise(F.lit(""))
    return joined.select("conv_id", "turn", "role", F.concat(quotes, F.lit("\n"), F.coalesce("text", F.lit(""))).alias("text"))


@query
def op10_quotations(spark: SparkSession, directory: str) -> DataFrame:
    return quotations.link_quotations(quoting_messages(table(spark, directory, "conversations")))


@query
def op11_fill_in_middle(spark: SparkSession, directory: str) -> DataFrame:
    out = fill_in_middle.fill_in_middle(table(spark, directory, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


@query
def op12_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    return token_counts.token_counts(table(spark, directory, "documents"), tokenizer_path("byte_bpe_50k.json"))


def tokenizer_path(name: str) -> str:
    """Where the installed vocabulary files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


CODES = vector_codes.Plan()


@query
def op13_vector_codes(spark: SparkSession, directory: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, directory, "embeddings"), CODES)


ORACLE_SQL: dict[str, str] = {}

_MIX_SQL = f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS s,
         greatest(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\r\\n]+')), 1)::BIGINT AS n_tokens FROM {{documents}}
), totals AS (SELECT s, sum(n_tokens)::BIGINT AS t FROM rows_ GROUP BY s
), shares AS (SELECT s, t, t / (SELECT sum(t) FROM totals)::DOUBLE AS p FROM totals
), flat(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END FROM (
    SELECT i, lo, hi, (lo + hi) / 2 AS mid, (SELECT ln(sum(pow(p, (lo + hi) / 2)))
      - (lo + hi) / 2 * sum(pow(p, (lo + hi) / 2) * ln(p)) / sum(pow(p, (lo + hi) / 2))
      >= {MIX.entropy} * ln(count(*)) FROM shares) AS ok FROM flat WHERE i < {mixing.BISECTIONS})
), flattest AS (
  SELECT CASE WHEN (SELECT -sum(p * ln(p)) >= {MIX.entropy} * ln(count(*)) FROM shares) THEN 1.0
         ELSE (SELECT lo FROM flat WHERE i = {mixing.BISECTIONS}) END AS a
), rep(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN many THEN mid ELSE lo END, CASE WHEN many THEN hi ELSE mid END FROM (
    SELECT i, lo, hi, (lo + hi) / 2 AS mid, (SELECT max(pow(p, (lo + hi) / 2) / t) * sum(t) / sum(pow(p, (lo + hi) / 2))
      > {MIX.max_epochs} FROM shares) AS many FROM rep WHERE i < {mixing.BISECTIONS})
), chosen AS (
  SELECT CASE WHEN (SELECT max(pow(p, a) / t) * sum(t) / sum(pow(p, a)) > {MIX.max_epochs} FROM shares, flattest)
         THEN (SELECT hi FROM rep WHERE i = {mixing.BISECTIONS}) ELSE (SELECT a FROM flattest) END AS a
), weighted AS (
  SELECT s, t, round(pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, chosen), {mixing.WEIGHT_DIGITS}) AS w FROM shares, chosen
), budgets AS (SELECT s, t, w, floor(w * (SELECT sum(t) FROM totals)::DOUBLE)::BIGINT AS b FROM weighted
), dealt AS (
  SELECT r.*, t, w, b, unnest(range(0, ceil(b / t)::BIGINT)) AS epoch FROM rows_ r JOIN budgets USING (s)
), keyed AS (SELECT *, md5('{MIX.seed}:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')) AS k FROM dealt
), placed AS (
  SELECT *, epoch * t + coalesce(sum(n_tokens) OVER (PARTITION BY s, epoch ORDER BY k, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM keyed
), kept AS (SELECT *, floor(start / (w * {float(MIX.block_tokens)}))::BIGINT AS block FROM placed WHERE start < b)
SELECT doc_id, source, n_tokens, epoch, block,
       row_number() OVER (PARTITION BY block ORDER BY md5(k || '#'), doc_id, source, n_tokens) AS position FROM kept
"""
ORACLE_SQL["op1_mixing"] = _MIX_SQL.format(documents="documents")

_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
_SIGS = f"""(SELECT CASE WHEN len(spots) > 0 THEN list_sort(list_distinct(spots)) ELSE [whole] END FROM (
  SELECT substr(md5(array_to_string(ws, ' ')), 1, {spotsigs.HASH_DIGITS}) AS whole,
    flatten(list_transform(range(1, len(parts) + 1), lambda i: CASE WHEN contains(parts[i], '^') THEN
      list_transform(list_slice(string_split(parts[i], '^'), 1, len(string_split(parts[i], '^')) - 1),
        lambda a: substr(md5(a || ':' || string_split(parts[i], '^')[-1] || ':' || coalesce(string_split(parts[i + 1], '^')[-1], '')),
          1, {spotsigs.HASH_DIGITS})) ELSE [] END)) AS spots
  FROM (SELECT ws, string_split(rtrim(array_to_string(list_transform(ws, lambda w: w ||
    CASE WHEN w IN ({", ".join(f"'{w}'" for w in spotsigs.ANCHORS)}) THEN '^' ELSE ' ' END), ''), ' '), ' ') AS parts
    FROM (SELECT {_WORDS} AS ws))))"""
ORACLE_SQL["op4_fingerprints"] = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id,
    coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS next_text
  FROM documents WINDOW o AS (ORDER BY doc_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), edits AS (
  SELECT *, left(text, length(text) - length(text) // 3) || left(next_text, length(text) // 3) AS edited FROM docs
), sigs AS (
  SELECT doc_id, text, edited, {_SIGS.format("text")} AS a, {_SIGS.format("edited")} AS e, {_SIGS.format("next_text")} AS n FROM edits
)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint,
  array_to_string(e, '') AS edited_fingerprint,
  len(list_intersect(a, e)) / (len(a) + len(e) - len(list_intersect(a, e)))::DOUBLE AS near_edited,
  len(list_intersect(a, n)) / (len(a) + len(n) - len(list_intersect(a, n)))::DOUBLE AS near_next,
  floor(ln(len(a)::DOUBLE) / 0.2231435513142097 + 1e-9)::INTEGER AS size_class
FROM sigs
"""

_HOST = r"rtrim(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.')"
ORACLE_SQL["op5_url_lists"] = f"""
WITH captures AS (
  SELECT page_id, url, (DATE '2024-01-01' + (page_id * 7919 % 366)::INTEGER)::DATE AS fetched, {_HOST} AS host,
    list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*/([^?#]*)', 1), '/'), lambda p: p <> '') AS path
  FROM pages
), hosts AS (
  SELECT DISTINCT host, instr('0123456789abcdef', substr(md5(host), 1, 1)) * 12 - 12 AS f,
    instr('0123456789abcdef', substr(md5(host), 2, 1)) - 1 AS d, regexp_replace(host, '^[^.]*\\.', '') AS parent
  FROM captures WHERE host <> ''
), log AS (
  SELECT unnest(CASE
    WHEN regexp_matches(host, 'spam|pills') THEN [{{'key': host, 'rank': 1, 'day': 0}}, {{'key': host, 'rank': 0, 'day': 300}}]
    WHEN d < 6 THEN [{{'key': host, 'rank': 1, 'day': f}}, {{'key': host, 'rank': 0, 'day': f + 40}},
      {{'key': host, 'rank': 1, 'day': f + 90}}, {{'key': host || '/en', 'rank': 2, 'day': f + 20}}]
    WHEN d < 9 THEN [{{'key': parent, 'rank': 1, 'day': f + 30}}, {{'key': parent, 'rank': 0, 'day': f + 60}},
      {{'key': host, 'rank': 2, 'day': f + 50}}] END) AS e FROM hosts
), daily AS (
  SELECT e.key AS key, (DATE '2024-01-01' + e.day::INTEGER)::DATE AS since, max(e.rank) AS rank FROM log GROUP BY 1, 2
), spans AS (
  SELECT key, rank, since, lead(since) OVER (PARTITION BY key ORDER BY since) AS until FROM daily
), hits AS (
  SELECT c.page_id, c.url, c.fetched, s.key, s.rank, s.since,
    row_number() OVER (PARTITION BY c.page_id, c.url, c.fetched ORDER BY length(s.key) DESC) AS n
  FROM captures c JOIN spans s ON s.rank > 0 AND c.fetched >= s.since AND (s.until IS NULL OR c.fetched < s.until)
    AND (c.host = s.key OR ends_with(c.host, '.' || s.key)
      OR list_contains(list_transform(range(1, len(path) + 1), lambda i: c.host || '/' || array_to_string(path[1:i], '/')), s.key))
  WHERE c.host <> ''
)
SELECT c.page_id, c.url, c.fetched::VARCHAR AS fetched,
  CASE h.rank WHEN 1 THEN 'blocked' WHEN 2 THEN 'allowed' ELSE 'unlisted' END AS decision,
  h.key AS entry, h.since::VARCHAR AS listed_since, count(*) AS n_captures
FROM captures c LEFT JOIN hits h ON h.n = 1 AND c.page_id = h.page_id AND c.url = h.url GROUP BY ALL
"""

_RUNS = """list_distinct(CASE WHEN len(ws) >= {0} THEN list_transform(range(1, len(ws) - {0} + 2),
  lambda i: array_to_string(ws[i:i + {0} - 1], ' ')) ELSE [] END)"""
_ASKED = "CASE WHEN (SELECT bool_or(n_words = {n}) FROM items) THEN {runs} ELSE [] END"
CONTAINED_SQL = f"""
items AS (
  SELECT item_id, least(len(ws), 5) AS n_words, CASE WHEN len(ws) >= 5 THEN {_RUNS.format(5)} ELSE [array_to_string(ws, ' ')] END AS runs
  FROM (SELECT item_id, {_WORDS.format("text")} AS ws FROM benchmark) WHERE len(ws) > 0
), item_runs AS (SELECT item_id, n_words, len(runs) AS n_shingles, unnest(runs) AS run FROM items
), doc_words AS (SELECT doc_id, {_WORDS.format("text")} AS ws FROM __documents__
), doc_runs AS (
  SELECT DISTINCT doc_id, unnest(list_concat({", ".join(_ASKED.format(n=n, runs=_RUNS.format(n)) for n in range(1, 6))})) AS run FROM doc_words
)"""
_CONTAINED = """
SELECT doc_id, item_id, n_shingles::BIGINT AS n_shingles, count(*) AS n_shared, count(*) / n_shingles::DOUBLE AS containment
FROM doc_runs JOIN item_runs USING (run) GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= n_shingles * 0.8
"""
ORACLE_SQL["op9_decontamination"] = f"WITH {CONTAINED_SQL.replace('__documents__', 'documents')} {_CONTAINED}"


ORACLE_SQL["op11_fill_in_middle"] = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), drawn AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n, list_transform([1, 9, 17, 25], lambda i: list_reduce(list_transform(
    range(0, 8), lambda k: instr('0123456789abcdef', substr(h, i + k, 1))::BIGINT - 1), lambda a, b: a * 16 + b)) AS d FROM units
), cut AS (
  SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 90 THEN 'plain'
         WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts
"""

_NEAREST = """held{r} AS MATERIALIZED (
  SELECT v, part, min(d * 256 + e) % 256 AS e, min(d * 256 + e) // 256 AS d FROM (
    SELECT v, part, e, sum((x - c) * (x - c)) AS d FROM points JOIN book{r} USING (part, place) GROUP BY v, part, e) GROUP BY v, part
)"""
_MOVED = """book{s} AS MATERIALIZED (
  SELECT b.part, b.e, b.place, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (
    SELECT part, e, place, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS c
    FROM points JOIN held{r} USING (v, part) GROUP BY part, e, place) m USING (part, e, place)
)"""
_ROUNDS = ", ".join(f"{_NEAREST.format(r=r)}, {_MOVED.format(r=r, s=r + 1)}" for r in range(CODES.rounds))
ORACLE_SQL["op13_vector_codes"] = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({CODES.scale} * x::DOUBLE)::BIGINT) AS xs,
    row_number() OVER (ORDER BY vec_id) AS v, len(embedding) // {CODES.parts} AS width
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS MATERIALIZED (
  SELECT v, (i - 1) // width AS part, (i - 1) % width AS place, x FROM (
    SELECT v, width, unnest(xs) AS x, unnest(range(1, len(xs) + 1)) AS i FROM kept)
), book0 AS MATERIALIZED (SELECT part, v - 1 AS e, place, x AS c FROM points WHERE v <= {CODES.entries}
), {_ROUNDS}, {_NEAREST.format(r=CODES.rounds)}, coded AS (
  SELECT v, string_agg(lpad(lower(to_hex(e::BIGINT)), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM held{CODES.rounds} GROUP BY v
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, e, place)) FROM book{CODES.rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (v)
"""

_NORMAL = r"trim(regexp_replace(lower({0}), '[ \t\r\n\f\x0B]+', ' ', 'g'))"
ORACLE_SQL["op10_quotations"] = rf"""
WITH RECURSIVE plain AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
), mail AS (
  SELECT c.conv_id, c.turn, c.role, CASE (c.conv_id + c.turn) % 3
      WHEN 1 THEN coalesce('> ' || replace(b.text, chr(10), chr(10) || '> ') || chr(10), '')
      WHEN 2 THEN coalesce('>> ' || replace(e.text, chr(10), chr(10) || '>> ') || chr(10), '')
        || coalesce('> ' || replace(b.text, chr(10), chr(10) || '> ') || chr(10), '')
      ELSE '' END || chr(10) || c.text AS text
  FROM plain c LEFT JOIN plain b ON b.conv_id = c.conv_id AND b.turn = c.turn - 1
  LEFT JOIN plain e ON e.conv_id = c.conv_id AND e.turn = c.turn - 2
), split AS (
  SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM mail
), marked AS (SELECT *, regexp_extract(line, '^[ 	
]*(?:>[ 	
]?)+') AS mark FROM split
), lines AS (
  SELECT conv_id, turn, place, len(regexp_replace(mark, '[^>]', '', 'g')) AS level, line[len(mark) + 1:] AS line,
    regexp_matches(line[len(mark) + 1:], '[^ 	
]') AS filled FROM marked
), begun AS (
  SELECT *, filled AND NOT coalesce(lag(filled) OVER w AND lag(level) OVER w = level, false) AS begins
  FROM lines WINDOW w AS (PARTITION BY conv_id, turn ORDER BY place)
), numbered AS (
  SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn ORDER BY place) AS run FROM begun
), runs AS (
  SELECT conv_id, turn, level, run, string_agg(line, ' ' ORDER BY place) AS whole FROM numbered WHERE filled GROUP BY ALL
), own AS (
  SELECT conv_id, turn, {_NORMAL.format("whole")} AS key FROM runs WHERE level = 0
  UNION ALL SELECT conv_id, turn, {_NORMAL.format("line")} FROM numbered WHERE filled AND level = 0
  UNION ALL SELECT conv_id, turn, {_NORMAL.format("string_agg(line, ' ' ORDER BY place)")} FROM numbered
    WHERE filled AND level = 0 GROUP BY conv_id, turn
), firsts AS (SELECT conv_id, key, min(turn) AS original FROM own GROUP BY conv_id, key
), asked AS (
  SELECT conv_id, turn, level, run, 0 AS rank, {_NORMAL.format("whole")} AS key FROM runs WHERE level > 0
  UNION ALL SELECT conv_id, turn, level, run, 1, {_NORMAL.format("line")} FROM numbered WHERE filled AND level > 0
), linked AS (
  SELECT a.conv_id, a.turn, a.level, a.run, f.original FROM asked a JOIN firsts f USING (conv_id, key) WHERE f.original < a.turn
  QUALIFY row_number() OVER (PARTITION BY a.conv_id, a.turn, a.run ORDER BY a.rank, f.original) = 1
), answers AS (
  SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id, turn) AS n_linked, original AS reply_to FROM linked
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, original DESC) = 1
), threads AS (
  SELECT m.conv_id, m.turn, m.turn AS thread, 0::BIGINT AS depth FROM mail m
  WHERE NOT EXISTS (SELECT 1 FROM answers a WHERE a.conv_id = m.conv_id AND a.turn = m.turn)
  UNION ALL SELECT a.conv_id, a.turn, t.thread, t.depth + 1 FROM threads t JOIN answers a ON a.conv_id = t.conv_id AND a.reply_to = t.turn
), texts AS (
  SELECT conv_id, turn, trim(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE level = 0), ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text
  FROM lines GROUP BY conv_id, turn
)
SELECT m.conv_id, m.turn, m.role, a.reply_to, t.thread, t.depth,
  (SELECT count(*) FROM runs r WHERE r.conv_id = m.conv_id AND r.turn = m.turn AND r.level > 0) AS n_quotes,
  coalesce(a.n_linked, 0)::BIGINT AS n_linked, x.text
FROM mail m JOIN threads t USING (conv_id, turn) LEFT JOIN answers a USING (conv_id, turn) JOIN texts x USING (conv_id, turn)
"""
