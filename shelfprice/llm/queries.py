"""Registered queries of this package: each operator over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.llm import chat, decontam, exact_dedup, filter_audit, fim, html_text, line_dedup, lm_score, mixing, quality, simhash_dedup, surrogates, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, twin: str | None = None) -> None:
    QUERIES[name] = query
    if twin is not None:
        ORACLES[name] = twin


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id_remainder(modulus: int) -> Column:
    """crc32 of the id as text, by which documents are held out."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


# --- op1: toxicity -----------------------------------------------------------------------------


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _id_remainder(3) == 1
    scores = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


register("op1_toxicity", toxicity_scores)

# --- op2: quality rules ------------------------------------------------------------------------


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def _quality_sql(rules: quality.Rules) -> str:
    steps = ", ".join(f"('{rule}', {i}, {cutoff})" for rule, walk in rules.walks.items() for i, cutoff in enumerate(walk))
    p = rules.limit
    word = r"[^\x20\x09-\x0D]"
    return rf"""
    WITH cut AS (
      SELECT doc_id, lang, coalesce(text, '') AS text,
        [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w,
        [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{word}')] AS l FROM documents),
    starts AS (
      SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM (
          SELECT doc_id, i, array_to_string(w[i:i + {quality.WINDOW - 1}], ' ') AS run
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - {quality.WINDOW - 2})) AS i FROM cut))) WHERE n > 1),
    repeats AS (
      SELECT doc_id, sum(least({quality.WINDOW}, coalesce(next - i, {quality.WINDOW})))::BIGINT AS n FROM starts GROUP BY doc_id),
    counts AS (
      SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g'))) AS n_capitals,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
        len([i FOR i IN range(1, len(w)) IF w[i] = w[i + 1]]) AS n_stutters, coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM cut LEFT JOIN repeats USING (doc_id)),
    measured AS (
      SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
        coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols, coalesce(n_capitals / nullif(word_chars, 0), 0) AS capitals,
        coalesce(n_stutters / nullif(n_words, 0), 0) AS stutter, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS same_lines
      FROM counts),
    long AS (UNPIVOT measured ON symbols, capitals, stutter, same_lines INTO NAME rule VALUE m),
    known AS (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id HAVING min(quality) IS NOT NULL),
    tests AS (
      SELECT lang, rule, step, cutoff, count_if(quality >= 1)::BIGINT AS n, count_if(quality >= 1 AND m > cutoff)::BIGINT AS k,
        count_if(quality < 1 AND m > cutoff) AS hits
      FROM long JOIN known USING (doc_id) JOIN (VALUES {steps}) s(rule, step, cutoff) USING (rule)
      WHERE NOT base_failed GROUP BY lang, rule, step, cutoff),
    passed AS (
      SELECT *, CASE WHEN k < n * {p} THEN list_sum([exp(lgamma(n + 1) - lgamma(j + 1)
          - lgamma(n - j + 1) + j * ln({p}) + (n - j) * ln(1 - {p})) FOR j IN range(0, k + 1)]) ELSE 1 END
        <= {rules.risk} / ((SELECT count(*) FROM (SELECT DISTINCT lang FROM tests)) * {len(rules.walks)}) AS ok FROM tests),
    certified AS (
      SELECT *, max(hits) OVER (PARTITION BY lang, rule) AS best
      FROM (SELECT *, bool_and(ok) OVER (PARTITION BY lang, rule ORDER BY step) AS sure FROM passed) WHERE sure),
    cutoffs AS (SELECT lang, rule, max(cutoff) AS cutoff FROM certified WHERE hits = best AND hits > 0 GROUP BY lang, rule)
    SELECT doc_id, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols,
      any_value(n_dup_lines) AS n_dup_lines, any_value(n_repeat_words) AS n_repeat_words, any_value(base_failed) AS base_failed,
      NOT any_value(base_failed) AND NOT bool_or(coalesce(m > cutoff, false)) AS kept
    FROM long LEFT JOIN cutoffs ON long.rule = cutoffs.rule AND long.lang IS NOT DISTINCT FROM cutoffs.lang
    GROUP BY doc_id
    """


register("op2_quality_rules", quality_rules, _quality_sql(quality.RULES))

# --- op5: chat formatting ----------------------------------------------------------------------

_SAID = "<|im_end|><|im_start|>assistant ok"


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(role).alias("role"), F.lit(_SAID).alias("text"))
                    for i, role in enumerate(("user", "assistant"))
                ]
            )
        ),
    )
    formatted = chat.format_conversations(turns.unionByName(extra))
    read = formatted.select(
        "conv_id",
        "valid",
        F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.trained_text(F.col("segments")).alias("loss"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )


def _escaped_sql(text: str) -> str:
    return rf"replace(replace({text}, '\', '\\'), '<|', '<\|')"


register(
    "op5_chat_format",
    chat_format,
    f"""
    WITH said AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-1::BIGINT, 0::BIGINT, 'user', '{_SAID}'), (-1::BIGINT, 1::BIGINT, 'assistant', '{_SAID}')),
    placed AS (
      SELECT *, lag(role) OVER w AS prev, lead(role) OVER w AS next FROM said
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
      sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
        AS loss_sha256,
      sum(length('{chat.OPEN}') + length(replace({_escaped_sql("role")}, chr(10), '\\n')) + 1
        + length({_escaped_sql("text")}) + length('{chat.CLOSE}') + 1)::BIGINT AS formatted_chars,
      bool_and(CASE role WHEN 'system' THEN prev IS NULL WHEN 'user' THEN prev IS NULL OR prev IN ('system', 'assistant')
        WHEN 'assistant' THEN prev IS NOT DISTINCT FROM 'user' ELSE false END)
        AND bool_and(next IS NOT NULL OR role = 'assistant') AS valid
    FROM placed GROUP BY conv_id
    """,
)

# --- op3: language model scores ----------------------------------------------------------------


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _id_remainder(7) == 2
    scores = lm_score.lm_scores(table(spark, sf_dir, "documents"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), *[c for c in scores.columns if c != "doc_id"])


register("op3_lm_scores", lm_scores)

# --- op4: surrogates ---------------------------------------------------------------------------

# A key for tests; whoever publishes rewritten texts sets a secret one.
TEST_KEY = b"key of the registered query"


def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rewritten, spans = surrogates.with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), TEST_KEY)
    kinds = F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["kind"])))
    return rewritten.select(
        "doc_id", "text", F.size(spans).cast("long").alias("n_entities"), F.array_join(kinds, ",").alias("kinds")
    )


register("op4_pii_surrogates", pii_surrogates)

# --- op6: repeated lines -----------------------------------------------------------------------


def line_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("removed", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return kept.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.array_join(spans, ",").alias("removed"))


_BLANK = r"[\x20\x09-\x0D]"

register(
    "op6_line_repeats",
    line_repeats,
    rf"""
    WITH lines AS (
      SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS unit FROM (
        SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
    cut AS (
      SELECT *, regexp_extract_all(line, '{_BLANK}*[^{_BLANK[1:]}+') AS tokens,
        (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY unit))::BIGINT - length(line) - 1 AS start FROM lines),
    placed AS (
      SELECT doc_id, unit, k, start, tokens[k] AS token,
        translate(regexp_replace(tokens[k], '^{_BLANK}+', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word,
        row_number() OVER (PARTITION BY doc_id ORDER BY unit, k) AS pos,
        start + (sum(length(tokens[k])) OVER (PARTITION BY doc_id, unit ORDER BY k))::BIGINT AS stop
      FROM (SELECT *, unnest(range(1, len(tokens) + 1)) AS k FROM cut)),
    texts AS (SELECT doc_id, list(word ORDER BY pos) AS w FROM placed GROUP BY doc_id),
    windows AS (
      SELECT doc_id, i, md5(array_to_string(w[i:i + {line_dedup.PASSAGE - 1}], ' ')) AS run
      FROM (SELECT *, unnest(range(1, len(w) - {line_dedup.PASSAGE - 2})) AS i FROM texts)),
    later AS (
      SELECT doc_id, i FROM (
        SELECT *, first_value(doc_id) OVER r AS first_doc, first_value(i) OVER r AS first_i FROM windows
        WINDOW r AS (PARTITION BY run ORDER BY doc_id, i))
      WHERE NOT (doc_id = first_doc AND i < first_i + {line_dedup.PASSAGE})),
    marked AS (
      SELECT placed.*, coalesce(max(i) OVER (PARTITION BY placed.doc_id ORDER BY pos) > pos - {line_dedup.PASSAGE}, false) AS gone
      FROM placed LEFT JOIN later ON placed.doc_id = later.doc_id AND pos = i),
    edges AS (
      SELECT *, bool_and(gone) OVER (PARTITION BY doc_id, unit) AS whole,
        gone AND NOT coalesce(lag(gone) OVER u, false) AS opens, gone AND NOT coalesce(lead(gone) OVER u, false) AS closes
      FROM marked WINDOW u AS (PARTITION BY doc_id, unit ORDER BY k)),
    kept AS (
      SELECT cut.doc_id, cut.unit, coalesce(any_value(whole), false) AS whole,
        coalesce(string_agg(token, '' ORDER BY k) FILTER (WHERE NOT gone), '')
          || any_value(regexp_extract(line, '{_BLANK}*$')) AS rest,
        any_value(cut.start) AS start, any_value(length(line)) AS n,
        list(stop - length(token) + length(regexp_extract(token, '^{_BLANK}*')) ORDER BY k) FILTER (WHERE opens) AS starts,
        list(stop ORDER BY k) FILTER (WHERE closes) AS stops
      FROM cut LEFT JOIN edges ON cut.doc_id = edges.doc_id AND cut.unit = edges.unit GROUP BY cut.doc_id, cut.unit),
    spans AS (
      SELECT doc_id, unit, whole, rest, CASE WHEN whole THEN [start || '-' || (start + n)]
        ELSE [starts[x] || '-' || stops[x] FOR x IN range(1, len(starts) + 1)] END AS cuts FROM
          (SELECT * REPLACE (coalesce(starts, []) AS starts, coalesce(stops, []) AS stops) FROM kept))
    SELECT documents.doc_id, CASE WHEN any_value(text) IS NOT NULL
        THEN coalesce(string_agg(rest, chr(10) ORDER BY unit) FILTER (WHERE NOT whole), '') END AS text,
      coalesce(sum(len(cuts)), 0)::BIGINT AS n_removed,
      coalesce(string_agg(array_to_string(cuts, ','), ',' ORDER BY unit) FILTER (WHERE len(cuts) > 0), '') AS removed
    FROM documents LEFT JOIN spans ON documents.doc_id = spans.doc_id GROUP BY documents.doc_id
    """,
)

# --- op7: benchmark passages -------------------------------------------------------------------


def benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


register("op7_benchmark_passages", benchmark_passages)

# --- op8: SimHash near-duplicates --------------------------------------------------------------


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


register("op8_simhash_groups", simhash_groups)

# --- op9: main text of pages -------------------------------------------------------------------

register("op9_main_text", lambda spark, sf_dir: html_text.extract_main_text(table(spark, sf_dir, "pages")))

# --- op10: mixing sources ----------------------------------------------------------------------


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


register("op10_mix_sources", mix_sources)

# --- op12: fill in the middle ------------------------------------------------------------------


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restore(fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))
    digests = [F.sha2(c, 256).alias(f"{name}_sha256") for c, name in (("output", "output"), ("restored", "restored"))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def _part_sql(start: str, end: str) -> str:
    return f"coalesce(array_to_string(u[{start}:{end}], ''), '')"


register(
    "op12_fill_in_middle",
    fill_in_middle,
    rf"""
    WITH drawn AS (
      SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
        [('0x' || substr(sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, '')), i, 8))::BIGINT FOR i IN [1, 9, 17, 25]] AS h
      FROM documents),
    cut AS (
      SELECT *, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= {fim.RATE_PERCENT}
          THEN 'plain' WHEN h[4] % 100 < {fim.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    parts AS (
      SELECT *, {_part_sql("1", "a")} AS prefix, {_part_sql("a + 1", "b")} AS middle, {_part_sql("b + 1", "len(u)")} AS suffix FROM cut)
    SELECT doc_id, len(u)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
    FROM parts
    """,
)

# --- op13: exact duplicates --------------------------------------------------------------------

register(
    "op13_exact_groups",
    lambda spark, sf_dir: exact_dedup.exact_groups(table(spark, sf_dir, "documents")),
    r"""
    WITH normal AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
      row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
    FROM normal WINDOW w AS (PARTITION BY t ORDER BY doc_id NULLS LAST)
    """,
)

# --- op11: filter interaction audit ------------------------------------------------------------


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


register(
    "op11_filter_audit",
    filter_interactions,
    rf"""
    WITH texts AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
    marks AS (
      SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
    cells AS (
      SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM (
        SELECT texts.doc_id, part, (len(w) < {filter_audit.MIN_WORDS})::INT
            + 2 * (100 * len(list_distinct(w)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(w))::INT
            + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {filter_audit.MAX_CAPITALS_PERCENT} * length(t))::INT
            + 8 * regexp_matches(t, '{filter_audit.SYMBOLS}')::INT
            + 16 * coalesce(texts.doc_id > min(texts.doc_id) OVER (PARTITION BY t), false)::INT AS mask, good, toxic
        FROM texts LEFT JOIN marks ON texts.doc_id = marks.doc_id) GROUP BY part, mask),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
    orders AS (
      SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM letters a JOIN letters b ON a.x <> b.x JOIN letters c ON c.x NOT IN (a.x, b.x)
        JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
    steps AS (
      SELECT filter_order, step::INTEGER AS step, bits[step] AS bit, list_sum(bits[1:step]) - bits[step] AS earlier
      FROM orders, unnest([1, 2, 3, 4, 5]) s(step)),
    counted AS (
      SELECT part, filter_order, step, bit,
        sum(n * (mask & (earlier + bit) = 0)::INT)::BIGINT AS kept,
        sum(n * (mask & earlier = 0 AND mask & bit > 0)::INT)::BIGINT AS removed,
        sum(n * (mask & earlier > 0 AND mask & bit > 0)::INT)::BIGINT AS redundant,
        sum(n * (mask = bit)::INT)::BIGINT AS unique_fails,
        sum(good * (mask & earlier = 0 AND mask & bit > 0)::INT)::BIGINT AS good_lost,
        sum(toxic * (mask & earlier = 0 AND mask & bit > 0)::INT)::BIGINT AS toxic_lost
      FROM cells, steps GROUP BY part, filter_order, step, bit)
    SELECT * EXCLUDE bit, sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM counted
    """,
)
