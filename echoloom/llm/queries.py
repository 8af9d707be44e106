"""The operators of this subpackage as queries over whole tables, with their DuckDB twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES, ORACLES = {}, {}

WORDS = r"'[^\x20\x09-\x0D]+'"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def register(sql: str | None = None):
    """Register a query under its function's name."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHINGLES = rf"""
  w AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWER}, {WORDS}) AS w FROM documents),
  s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS g FROM w),
  n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)"""


@register(rf"""
WITH RECURSIVE {SHINGLES},
  links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
          FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
    JOIN n a ON a.doc_id = p.a JOIN n b ON b.doc_id = p.b
    WHERE 100 * c >= 85 * (a.n + b.n - c)),
  reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
  least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(l.b, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least l ON l.a = d.doc_id""")
def op6_near_dups(spark, sf_dir):
    """Near-duplicate components of all documents."""
    from echoloom.llm.near_dups import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@register(rf"""
WITH {SHINGLES},
  b AS MATERIALIZED (SELECT item_id, regexp_extract_all({LOWER}, {WORDS}) AS w FROM benchmark),
  t AS MATERIALIZED (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS g FROM b),
  m AS (SELECT item_id, count(*) AS n_item FROM t GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, round(count(*) / n_item, 6) AS containment
FROM t JOIN s USING (g) JOIN m USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 10 * count(*) >= 8 * n_item""")
def op1_decontaminate(spark, sf_dir):
    """Benchmark items that documents contain."""
    from echoloom.llm.decontaminate import contaminated
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row_key").withColumn("containment", F.round("containment", 6))


@register()
def op2_line_chunks(spark, sf_dir):
    """All documents without chunks of lines that stand elsewhere before."""
    from echoloom.llm.line_chunks import dedup_lines
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_removed_chunks", "n_removed_lines", "removed_bytes", "text")


@register()
def op8_quality_classifier(spark, sf_dir):
    """A quality score for every document."""
    from echoloom.llm.quality import quality_scores
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register()
def op10_mix(spark, sf_dir):
    """What the mix takes of every document."""
    from echoloom.llm.mixing import SIZE, copies
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.expr(SIZE).cast("long").alias("size"))
    return copies(rows).select("doc_id", "size", "source_size", "target",
                               (F.col("size") * F.col("copies")).alias("taken"), "copies")


def _secret_sql():
    """Matches and their places from the pieces between them, per kind."""
    from echoloom.llm.secrets import ASSIGN, MORE
    q = lambda t: "'" + t.replace("'", "''") + "'"
    rules = [("assign", ASSIGN, f"len(regexp_extract(m, {q(ASSIGN)}, 2)) >= 6"), ("access", "AKIA[A-Z0-9]+", "len(m) >= 20"),
             ("hex", "[0-9a-f]+", "len(m) >= 24")] + [(r.kind, r.pattern, f"len(m) >= {r.least}") for r in MORE]
    parts = [f"""SELECT doc_id, {i} AS k, '{kind}' AS kind, m, s FROM (
        SELECT doc_id, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i:
          coalesce(list_sum(list_transform(ps[1:i], lambda p: len(p))), 0)
          + coalesce(list_sum(list_transform(ms[1:i - 1], lambda p: len(p))), 0)))::BIGINT AS s
        FROM (SELECT doc_id, regexp_extract_all(t, {q(p)}) AS ms, string_split_regex(t, {q(p)}) AS ps FROM d))
      WHERE {good}""" for i, (kind, p, good) in enumerate(rules)]
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS MATERIALIZED ({' UNION ALL '.join(parts)}),
  g AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
    count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || (s + len(m)), ',' ORDER BY s, k) FILTER (k < 3) AS base,
    string_agg(kind || ':' || s || ':' || (s + len(m)), ',' ORDER BY s, k) AS spans FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN g USING (doc_id)"""


@register(_secret_sql())
def op3_secret_scan(spark, sf_dir):
    """Secrets in every document."""
    from echoloom.llm.secrets import BASE, scan
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in BASE]
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in kinds],
                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("secrets")).alias("spans"))


CONTROL = r"\### Assistant: </turn> ok"


@register(rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{CONTROL}'), (-7, 1, 'assistant', '{CONTROL}')),
  r AS (SELECT *, row_number() OVER o AS rn, len(regexp_extract_all(text, {WORDS})) + 4 AS tokens,
      14 + len(role) + len(text) + len(regexp_replace(role || text, '[^\\<#]', '', 'g'))
        + len(regexp_replace(role, '[^\n]', '', 'g')) AS size
    FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
  h AS (SELECT *, rn = 1 AND role = 'system' AS is_head,
      max(CASE WHEN rn = 1 AND role = 'system' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS head,
      max(CASE WHEN rn = 1 AND role = 'system' THEN size ELSE 0 END) OVER (PARTITION BY conv_id) AS head_size FROM r),
  p AS (SELECT *, CASE WHEN is_head THEN 0 ELSE tokens END AS cost, greatest(416 - head, 128) // 2 AS cell,
      sum(CASE WHEN is_head THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS after FROM h),
  w AS (SELECT *, after - cost AS before, 2 * (greatest(after - 1, 0) // cell) + CASE WHEN cost > cell THEN 0 ELSE 1 END AS win FROM p),
  l AS (SELECT *, lag(win) OVER o AS last, lag(size) OVER o AS s1, lag(size, 2) OVER o AS s2, lag(before) OVER o AS b1,
      lag(before, 2) OVER o AS b2, lag(is_head) OVER o AS h1, lag(is_head, 2) OVER o AS h2,
      bool_or(is_head) OVER (PARTITION BY conv_id, win) AS has_head
    FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY rn))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size + CASE WHEN last IS DISTINCT FROM win THEN CASE WHEN has_head THEN 0 ELSE head_size END
    + CASE WHEN NOT h1 AND before - b1 <= 96 THEN s1 ELSE 0 END + CASE WHEN NOT h2 AND before - b2 <= 96 THEN s2 ELSE 0 END
    ELSE 0 END)::BIGINT AS formatted_chars
FROM l GROUP BY conv_id""")
def op4_chat_format(spark, sf_dir):
    """All conversations, and one of control strings, formatted in windows and read back."""
    from echoloom.llm.chat import read_back, windows
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)],
                                    "conv_id long, turn long, role string, text string")
    return read_back(windows(talks.unionByName(control)))


def _url_sql():
    from echoloom.llm.url_rules import HOSTS, LOWER as low, PATTERNS, UPPER as up
    q = lambda t: "'" + t.replace("'", "''") + "'"
    key = f"translate(host || path, '{up}', '{low}')"
    ordered = sorted(HOSTS, key=lambda r: (-len(r.text), r.text))
    fits = lambda r: "(host = {0} OR suffix(host, {1})) AND starts_with(path, {2})".format(
        q(r.text.split("/", 1)[0]), q("." + r.text.split("/", 1)[0]), q("/" + r.text.split("/", 1)[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN {q(r.text)}" for r in ordered) + " END"
    said = "CASE " + " ".join(f"WHEN rule = {q(r.text)} THEN {q(r.verdict)}" for r in ordered)
    pattern = "CASE " + " ".join(f"WHEN regexp_matches({key}, {q(p.regex)}) THEN {q(p.text)}"
                                 for p in sorted(PATTERNS, key=lambda p: p.text)) + " END"
    return f"""
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{up}', '{low}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
  c AS (SELECT *, {rule} AS rule, {pattern} AS pattern FROM b)
SELECT page_id, host, path, rule, pattern, {said} WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM c"""


@register(_url_sql())
def op5_url_filter(spark, sf_dir):
    """A verdict for every page's URL."""
    from echoloom.llm.url_rules import judge
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


@register()
def op7_quality_rules(spark, sf_dir):
    """Statistics and verdict for every document."""
    from echoloom.llm.decision_rules import judged
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register()
def op9_license_scan(spark, sf_dir):
    """Licence families that documents name."""
    from echoloom.llm.licenses import licenses
    return licenses(table(spark, sf_dir, "documents"))


def _nibbles():
    """The CRC-32 steps of four bits, from its polynomial."""
    out = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


@register(rf"""
WITH RECURSIVE
  r AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents),
  d AS MATERIALIZED (SELECT doc_id, w, count(*) AS c, hex(encode(concat(doc_id, ':', w))) AS k FROM r WHERE len(w) >= 5 GROUP BY ALL),
  h AS (SELECT w, c, xor(4294967295, list_reduce(list_transform(range(1, len(k) + 1),
      lambda i: instr('123456789ABCDEF', substr(k, CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END, 1))::BIGINT),
      lambda a, x: xor({_nibbles()}[1 + (xor(a, x) & 15)], a >> 4), 4294967295::BIGINT)) AS h FROM d),
  t AS (SELECT c, CASE WHEN h % 97 = 0 THEN left(w, (h % len(w))::INT) || substr(w, (h % len(w))::INT + 2) ELSE w END AS w FROM h),
  v AS MATERIALIZED (SELECT w, sum(c)::BIGINT AS n FROM t WHERE len(w) >= 5 GROUP BY w HAVING sum(c) >= 3),
  s AS MATERIALIZED (SELECT w, i, left(w, i - 1) AS p, substr(w, i + 1) AS e FROM (SELECT w, unnest(range(1, len(w) + 1))::INT AS i FROM v)),
  x AS (SELECT DISTINCT s.w AS a, v.w AS b FROM s JOIN v ON v.w = s.p || s.e),
  near AS MATERIALIZED (SELECT a, b FROM x UNION ALL SELECT b, a FROM x
    UNION ALL SELECT y.w, z.w FROM s y JOIN s z ON y.p = z.p AND y.e = z.e AND y.w <> z.w),
  best AS (SELECT a, count(*) AS n_near, first(b ORDER BY v.n DESC, b) AS b, max(v.n) AS bn FROM near JOIN v ON v.w = b GROUP BY a),
  f AS MATERIALIZED (SELECT w, n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 2 * n THEN b END AS form,
    CASE WHEN bn >= 2 * n THEN bn END AS form_n FROM v LEFT JOIN best ON a = w),
  up(w, top) AS (SELECT w, w FROM f UNION ALL SELECT up.w, f.form FROM up JOIN f ON f.w = up.top WHERE f.form IS NOT NULL)
SELECT f.w AS word, f.form, up.top AS root, f.n, f.n_near, f.form_n
FROM f JOIN up ON up.w = f.w JOIN f g ON g.w = up.top AND g.form IS NULL""")
def op11_spelling_variants(spark, sf_dir):
    """Words of all documents with their near words and forms."""
    from echoloom.llm.spelling import variants
    return variants(table(spark, sf_dir, "documents"))


@register(r"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('1:', doc_id)) AS h FROM documents),
  b AS (SELECT *, len(t)::BIGINT AS n, list_transform(range(0, 4), lambda i: ('0x' || substr(h, 8 * i::INT + 1, 8))::BIGINT) AS g FROM a),
  c AS (SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR g[3] % 100 >= 90 THEN 'plain'
      WHEN g[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    least(g[1] % (n + 1), g[2] % (n + 1)) AS lo, greatest(g[1] % (n + 1), g[2] % (n + 1)) AS hi FROM b),
  e AS (SELECT *, left(t, lo) AS p, substr(t, lo + 1, hi - lo) AS m, substr(t, hi + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256, sha256(t) AS restored_sha256
FROM e""")
def op12_fill_in_middle(spark, sf_dir):
    """Every document as a fill-in-the-middle example, and what it was made of."""
    from echoloom.llm.infill import fill_in_middle, restored
    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(), 256).alias("restored_sha256"))


@register()
def op13_pack(spark, sf_dir):
    """All documents packed into sequences of at most 1024 tokens."""
    import public_tokenizers

    from echoloom.llm.packing import pack
    out = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
