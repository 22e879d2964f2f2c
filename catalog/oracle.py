"""The registered queries as SQL for DuckDB: plain text, nothing imported from the library."""

from __future__ import annotations

# The base list of English stop words, 318 words.
BASE = """
a about above across after afterwards again against all almost alone along already also
although always am among amongst amoungst amount an and another any anyhow anyone
anything anyway anywhere are around as at back be became because become becomes becoming
been before beforehand behind being below beside besides between beyond bill both bottom
but by call can cannot cant co con could couldnt cry de describe detail do done down due
during each eg eight either eleven else elsewhere empty enough etc even ever every
everyone everything everywhere except few fifteen fifty fill find fire first five for
former formerly forty found four from front full further get give go had has hasnt have
he hence her here hereafter hereby herein hereupon hers herself him himself his how
however hundred i ie if in inc indeed interest into is it its itself keep last latter
latterly least less ltd made many may me meanwhile might mill mine more moreover most
mostly move much must my myself name namely neither never nevertheless next nine no
nobody none noone nor not nothing now nowhere of off often on once one only onto or
other others otherwise our ours ourselves out over own part per perhaps please put
rather re same see seem seemed seeming seems serious several she should show side since
sincere six sixty so some somehow someone something sometime sometimes somewhere still
such system take ten than that the their them themselves then thence there thereafter
thereby therefore therein thereupon these they thick thin third this those though three
through throughout thru thus to together too top toward towards twelve twenty two un
under until up upon us very via was we well were what whatever when whence whenever
where whereafter whereas whereby wherein whereupon wherever whether which while whither
who whoever whole whom whose why will with within without would yet you your yours
yourself yourselves
""".split()

# Words left out of term reports on top of the base list.
MORE = (
    "anything something everything really just also "
    "movies movie restaurants restaurant tweets tweet ni"
).split()


def _listed(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _base() -> list[str]:
    return BASE


def _report() -> list[str]:
    return sorted({*BASE, *MORE})


def _cleaned(text: str, control: str = r"\\[nrtfvba0]+") -> str:
    step = f"regexp_replace({text}, '{control}', ' ', 'g')"
    step = rf"regexp_replace({step}, '\\u[0-9a-fA-F]{{4}}', ' ', 'g')"
    return rf"replace({step}, '\', ' ')"


def _plain_tokens(text: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({text}), '[a-z'']+'), lambda t: length(t) > 1)"
    )


def _check_tokens(text: str) -> str:
    return f"list_filter({_plain_tokens(text)}, lambda t: t NOT IN ({_listed(_base())}))"


def _report_tokens(text: str) -> str:
    found = f"regexp_extract_all(lower({_cleaned(text)}), '[a-z'']+')"
    stripped = f"list_transform({found}, lambda t: trim(t, ''''))"
    return (
        f"list_filter({stripped}, lambda t: length(t) > 1 AND t NOT IN ({_listed(_report())}))"
    )


def _model_words(text: str) -> str:
    found = rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')"
    return f"list_filter({found}, lambda t: t NOT IN ({_listed(_base())}))"


DOCS = "docs AS (SELECT doc_id AS row_id, source AS grp, lang, text, n_chars FROM documents)"
LD = """ld AS (
  SELECT d.doc_id AS row_id, d.source AS grp, d.lang, d.text, d.n_chars,
         CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
              ELSE 'neutral' END AS sentiment
  FROM documents d JOIN labels l USING (doc_id))"""
GAPPY = f"""{LD.replace("JOIN labels", "LEFT JOIN labels")}, gappy AS (
  SELECT row_id, grp, lang,
         CASE WHEN grp = 'src3' THEN NULL
              WHEN grp = 'src4' THEN ' ' || chr(9) || chr(10) ELSE text END AS text,
         CASE WHEN lang <> 'de' THEN sentiment END AS label
  FROM ld)"""
GUESS = """CASE WHEN n_chars < 600 THEN 'negative' WHEN n_chars < 1200 THEN 'neutral'
              ELSE 'positive' END"""
CLEAN = r"""text IS NOT NULL AND label IS NOT NULL
            AND regexp_matches(text, '[^\s\x0b\x1c-\x1f\x{85}\p{Z}]')"""
SENTIMENTS = "(VALUES ('negative'), ('neutral'), ('positive'))"


def _terms() -> str:
    """Token rows of labelled documents under the report tokeniser."""
    tokens = _report_tokens("text")
    return f"""{LD}, toks AS (SELECT row_id, sentiment, text, {tokens} AS tokens FROM ld),
  term_rows AS (SELECT row_id, sentiment, unnest(tokens) AS term FROM toks),
  counts AS (SELECT sentiment, term, count(*) AS count FROM term_rows GROUP BY ALL),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY sentiment
             ORDER BY count DESC, term) AS rank FROM counts)"""


def _group_terms() -> str:
    return f"""{LD}, rows_ AS (
    SELECT grp, sentiment, unnest({_plain_tokens('text')}) AS term FROM ld
    WHERE sentiment IN ('positive', 'negative')),
  counts AS (SELECT grp, sentiment, term, count(*) AS count FROM rows_ GROUP BY ALL),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY grp, sentiment
             ORDER BY count DESC, term) AS rank FROM counts)"""


def _examples() -> str:
    return f"""{_terms()}, hits AS (
    SELECT DISTINCT t.row_id, t.sentiment, t.term, t.text
    FROM (SELECT row_id, sentiment, text, unnest(tokens) AS term FROM toks) t
    JOIN ranked r ON r.sentiment = t.sentiment AND r.term = t.term AND r.rank <= 20),
  ex AS (SELECT *, row_number() OVER (PARTITION BY sentiment, term ORDER BY row_id)
         AS example_rank FROM hits)"""


def _all_counts(tokens: str, text: str = "text") -> str:
    return f"""SELECT term, count(*) AS count FROM (
      SELECT unnest({tokens}) AS term FROM (SELECT {text} AS text FROM documents)) GROUP BY term"""


ESCAPED = r"replace(text, chr(10), '\n')"
ROWS = f"""{LD}, pairs AS (SELECT sentiment AS actual, {GUESS} AS predicted FROM ld),
  counts AS (SELECT actual, predicted, count(*) AS count FROM pairs GROUP BY ALL),
  grid AS (SELECT a.c AS actual, p.c AS predicted FROM {SENTIMENTS} a(c), {SENTIMENTS} p(c)),
  cells AS (SELECT g.actual, g.predicted, coalesce(c.count, 0) AS count
            FROM grid g LEFT JOIN counts c USING (actual, predicted))"""


def _report_of(pairs: str = "pairs") -> str:
    return f"""classes AS (SELECT actual AS class FROM {pairs}
                           UNION SELECT predicted FROM {pairs}),
  raw AS (SELECT class,
      (SELECT count(*) FROM {pairs} WHERE actual = class AND predicted = class)::DOUBLE AS tp,
      (SELECT count(*) FROM {pairs} WHERE predicted = class)::DOUBLE AS said,
      (SELECT count(*) FROM {pairs} WHERE actual = class) AS support FROM classes),
  pr AS (SELECT class, coalesce(tp / nullif(said, 0), 0) AS p,
                coalesce(tp / nullif(support::DOUBLE, 0), 0) AS r, support FROM raw),
  rep AS (SELECT class, p AS precision, r AS recall,
                 coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1, support FROM pr)"""


REPORT = """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
                   round(f1, 6) AS f1, support FROM rep"""


def _shifted() -> str:
    key = "coalesce(grp, 'unknown') AS g, coalesce(text, '') AS t"
    number = "row_number() OVER (PARTITION BY grp, text ORDER BY row_id) AS k"
    return f"""{DOCS}, {LD},
  left_ AS (SELECT row_id, {key}, {number}, {GUESS} AS predicted FROM docs),
  right_ AS (SELECT {key}, {number}, sentiment AS actual FROM ld),
  pairs AS (SELECT row_id, actual, predicted FROM left_ JOIN right_ USING (g, t, k))"""


def _tf(rows: str, terms: str) -> str:
    return f"""tf AS (SELECT row_id, term, count(*) AS tf FROM (
      SELECT row_id, unnest({terms}) AS term FROM {rows}) GROUP BY ALL),
  n AS (SELECT count(*) AS n FROM {rows}),
  stats AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY term)"""


def _bigrams(rows: str) -> str:
    words = f"w AS (SELECT row_id, {_model_words('text')} AS w FROM {rows})"
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"{words}, {_tf('w', f'list_concat(w, {pairs})')}"


def _characters(rows: str) -> str:
    split = rf"regexp_split_to_array(lower(text), '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+')"
    return rf"""c1 AS (SELECT row_id, ' ' || unnest({split}) || ' ' AS p FROM {rows}),
  c2 AS (SELECT row_id, p, unnest([3, 4, 5]) AS size FROM c1 WHERE p <> '  '),
  c3 AS (SELECT row_id, p, size, unnest(range(1, length(p) - size + 2)) AS pos FROM c2),
  tf AS (SELECT row_id, substring(p, pos, size) AS term, count(*) AS tf FROM c3 GROUP BY ALL),
  n AS (SELECT count(*) AS n FROM {rows}),
  stats AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY term)"""


def _weights(cut: str, sublinear: bool) -> str:
    tf = "(1 + ln(tf))" if sublinear else "tf"
    return f"""raw AS (SELECT row_id, term, {tf} * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w
    FROM tf JOIN stats USING (term), n WHERE {cut}),
  tfidf AS (SELECT row_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS weight
    FROM raw)"""


BIGRAM_CUT = "df >= 2 AND df <= 0.98::DOUBLE * n"
SUMMARY = """SELECT row_id, count(*) AS terms, round(sum(weight), 4) AS weight_sum,
                    round(max(weight), 6) AS weight_max FROM tfidf GROUP BY row_id"""


def _scores() -> str:
    tokens = _report_tokens("text")
    score = "round(coalesce(sum({0}), 0) + (SELECT s FROM share WHERE sentiment = '{0}'), 6)"
    columns = ", ".join(f"{score.format(c)} AS {c}" for c in ("negative", "neutral", "positive"))
    weight = """round(ln((coalesce(sum(count) FILTER (sentiment = '{0}'), 0) + 1)::DOUBLE
      / ((SELECT sum(count) FROM counts WHERE sentiment = '{0}')
         + (SELECT count(DISTINCT term) FROM counts))::DOUBLE), 6) AS {0}"""
    weights = ", ".join(weight.format(c) for c in ("negative", "neutral", "positive"))
    return f"""{_terms()}, {DOCS},
  share AS (SELECT sentiment, round(ln(count(*)::DOUBLE / (SELECT count(*) FROM ld)), 6) AS s
            FROM ld GROUP BY sentiment),
  weights AS (SELECT term, {weights} FROM counts GROUP BY term),
  doc_terms AS (SELECT row_id, unnest({tokens}) AS term FROM docs),
  scores AS (SELECT d.row_id, {columns}
    FROM docs d LEFT JOIN doc_terms t USING (row_id) LEFT JOIN weights w USING (term)
    GROUP BY d.row_id)"""


# Documents and conversations with their category in front of the text.
_SOURCES = """docs AS (
  SELECT row_id, grp, concat_ws(' ', grp, text) AS text FROM (
    SELECT doc_id::VARCHAR AS row_id, 'articles' AS grp, text FROM documents
    UNION ALL SELECT conv_id || ':' || turn, 'talks', text FROM conversations))"""
BEST = """CASE WHEN negative >= neutral AND negative >= positive THEN 'negative'
     WHEN neutral >= positive THEN 'neutral' ELSE 'positive' END"""
EXPERIMENTS = r"""runs AS (
  SELECT regexp_extract(source, '(\d+)', 1)::BIGINT AS max_docs,
         (list_position(['de', 'en', 'es', 'fr'], lang) * 500)::BIGINT AS chunk_size,
         1::BIGINT AS workers, min(doc_id) AS run_seq, count(*) AS processed_docs,
         sum(n_chars)::DOUBLE / 1000 AS elapsed_seconds
  FROM documents GROUP BY source, lang)"""
SPEEDUP = """round(first_value(elapsed_seconds) OVER (PARTITION BY max_docs ORDER BY run_seq)
  / nullif(elapsed_seconds, 0), 6) AS speedup_vs_first_chunk"""
SHUFFLE = "md5(concat(row_id::VARCHAR, '|42'))"
SOURCES = """sources AS (
  SELECT text, CASE WHEN n_chars % 5 IN (0, 1) THEN 'negative' WHEN n_chars % 5 = 2
         THEN 'neutral' ELSE 'positive' END AS label,
         'articles' AS category, 'documents' AS source_dataset FROM documents
  UNION ALL
  SELECT text, CASE length(text) % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral'
         ELSE 'positive' END, 'talks', 'conversations' FROM conversations)"""


def _frequency_check(first: str, second: str, rows: str) -> str:
    return f"""sample AS ({rows}),
  a AS (SELECT term, count(*) AS n FROM (SELECT unnest({first}) AS term FROM sample) GROUP BY 1),
  b AS (SELECT term, count(*) AS n FROM (SELECT unnest({second}) AS term FROM sample) GROUP BY 1),
  o AS (SELECT coalesce(sum(least(a.n, b.n)), 0)::BIGINT AS overlap FROM a JOIN b USING (term)),
  t AS (SELECT count(*) AS terms, greatest(coalesce(sum(n), 0), 1)::BIGINT AS total FROM a)
  SELECT (SELECT count(*) FROM sample) AS checked_rows, terms AS unique_terms,
         total AS token_total, overlap AS overlap_tokens,
         round(overlap::DOUBLE / total, 6) AS match_ratio FROM o, t"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name; queries that fit models iteratively have none."""
    check, plain, report = _check_tokens("text"), _plain_tokens("text"), _report_tokens("text")
    average = "round(avg(len(tokens)), 6)"
    union_part = "SELECT 'word' AS part, weight FROM"
    strict = _cleaned("text", r"\\[nrtfvba0]")
    return {
        "normalise_documents": f"""WITH {GAPPY} SELECT row_id, coalesce(text, '') AS text,
            coalesce(label, 'unknown') AS "group" FROM gappy""",
        "normalise_without_group": f"""WITH {GAPPY} SELECT row_id, coalesce(text, '') AS text,
            'unknown' AS "group" FROM gappy""",
        "clean_training_rows": f"WITH {GAPPY} SELECT row_id, label, text FROM gappy WHERE {CLEAN}",
        "cleaning_counts": f"""WITH {GAPPY}, c AS (SELECT count(*) AS b,
            count(*) FILTER ({CLEAN}) AS a FROM gappy)
            SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed FROM c""",
        "map_labels": """SELECT doc_id AS row_id,
            CASE WHEN l IN (0, 1) THEN 'negative' WHEN l = 2 THEN 'neutral'
                 ELSE 'positive' END AS five,
            CASE WHEN l IN (0, 1) THEN 'negative' WHEN l = 2 THEN 'neutral'
                 WHEN l IN (3, 4) THEN 'positive' END AS five_strict,
            CASE l WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS three,
            CASE l WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' END
              AS three_strict
            FROM (SELECT doc_id, n_chars % 7 AS l FROM documents)""",
        "model_input": f"""WITH {GAPPY} SELECT row_id, lang || ' ' || text AS model_input,
            lang AS "group" FROM gappy""",
        "union_sources": f"WITH {SOURCES} SELECT * FROM sources",
        "corpus_counts": f"""WITH {SOURCES}
            SELECT 'category' AS dimension, category AS value, count(*) AS count
              FROM sources GROUP BY ALL
            UNION ALL SELECT 'label', label, count(*) FROM sources GROUP BY ALL
            UNION ALL SELECT 'source_dataset', source_dataset, count(*)
              FROM sources GROUP BY ALL""",
        "preview": """SELECT doc_id AS row_id, source AS "group",
            substring(text, 1, 120) AS text FROM documents ORDER BY doc_id LIMIT 10""",
        "first_n_documents": """SELECT doc_id AS row_id, source AS "group", text
            FROM documents ORDER BY doc_id LIMIT 100""",
        "row_numbers": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id, text
            FROM documents""",
        "file_row_numbers": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id
            FROM documents""",
        "prepare_training": f"""WITH raw AS (
              SELECT doc_id AS row_id, text, 'articles' AS grp, 'documents' AS src,
                CASE WHEN n_chars % 5 IN (0, 1) THEN 'negative' WHEN n_chars % 5 = 2
                  THEN 'neutral' ELSE 'positive' END AS label FROM documents
              UNION ALL
              SELECT conv_id * 1000 + turn, text, 'talks', 'conversations',
                CASE length(text) % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral'
                  ELSE 'positive' END FROM conversations),
            chosen AS (SELECT * FROM raw
              QUALIFY row_number() OVER (PARTITION BY src ORDER BY {SHUFFLE}) <= 300),
            keyed AS (SELECT src || '|' || row_id AS row_id, grp, label,
              grp || ' ' || text AS model_input FROM chosen WHERE {CLEAN})
            SELECT row_id, grp AS "group", label, model_input,
              CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {SHUFFLE})
                <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY label))
                THEN 'test' ELSE 'train' END AS split FROM keyed""",
        "exact_sample": f"""WITH {DOCS} SELECT row_id, grp AS "group" FROM docs
            QUALIFY row_number() OVER (ORDER BY {SHUFFLE}) <= 60""",
        "exact_sample_by_group": f"""WITH {DOCS} SELECT row_id, lang FROM docs
            QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {SHUFFLE}) <= 40""",
        "stratified_split": f"""WITH {LD} SELECT row_id, sentiment AS label,
            CASE WHEN row_number() OVER (PARTITION BY sentiment ORDER BY {SHUFFLE})
              <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY sentiment))
              THEN 'test' ELSE 'train' END AS split FROM ld""",
        "ordinals": """SELECT doc_id AS row_id,
            row_number() OVER (PARTITION BY text ORDER BY doc_id) - 1 AS ordinal
            FROM documents""",
        "tokenise_report": _all_counts(report),
        "tokenise_check": _all_counts(check),
        "tokenise_plain": _all_counts(plain),
        "token_sizes": f"SELECT doc_id AS row_id, len({report}) AS tokens FROM documents",
        "escape_cleaning": f"""SELECT doc_id AS row_id, {_cleaned('text')} AS cleaned,
            {strict} AS cleaned_strict
            FROM (SELECT doc_id, {ESCAPED} AS text FROM documents)""",
        "escaped_term_counts": _all_counts(report, ESCAPED),
        "term_counts": f"WITH {_terms()} SELECT * FROM counts",
        "term_counts_by_group": f"""WITH {_group_terms()}
            SELECT grp AS "group", sentiment, term, count FROM counts""",
        "top_terms_by_sentiment": f"WITH {_terms()} SELECT * FROM ranked WHERE rank <= 20",
        "top_terms_by_group": f"""WITH {_group_terms()}
            SELECT grp AS "group", sentiment, term, count, rank FROM ranked WHERE rank <= 20""",
        "term_examples": f"""WITH {_examples()} SELECT sentiment, term, example_rank, row_id,
            text AS message FROM ex WHERE example_rank <= 5""",
        "term_report": f"""WITH {_examples()}, joined AS (SELECT sentiment, term,
              string_agg(text, '|' ORDER BY example_rank) AS examples
            FROM ex WHERE example_rank <= 5 GROUP BY ALL)
            SELECT sentiment, rank, term, count, examples
            FROM ranked LEFT JOIN joined USING (sentiment, term) WHERE rank <= 20""",
        "work_statistics": f"""WITH {_terms()} SELECT sentiment, count(*) AS document_count,
              sum(len(tokens))::BIGINT AS total_term_count,
              (SELECT count(*) FROM counts c WHERE c.sentiment = t.sentiment)
                AS distinct_term_count,
              {average} AS average_tokens_per_doc,
              min(len(tokens)) AS min_tokens_per_doc, max(len(tokens)) AS max_tokens_per_doc
            FROM toks t GROUP BY sentiment""",
        "top_terms_overall": f"""WITH {_terms()} SELECT sentiment, term, count FROM counts
            ORDER BY count DESC, term, sentiment LIMIT 50""",
        "merged_top_terms": f"""WITH {_group_terms()}, merged AS (
              SELECT sentiment, term, sum(count)::BIGINT AS count FROM ranked
              WHERE rank <= 20 GROUP BY ALL)
            SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY count DESC, term)
              AS rank FROM merged QUALIFY rank <= 10""",
        "most_common_terms": f"""WITH t AS (SELECT doc_id, {check} AS w FROM documents),
            r AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos FROM t)
            SELECT term, count(*) AS count, min(doc_id) AS first_row_id FROM r GROUP BY term
            ORDER BY count(*) DESC, min((doc_id, pos)) LIMIT 20""",
        "term_frequency_check": "WITH "
        + _frequency_check(check, report, f"SELECT {ESCAPED} AS text FROM documents"),
        "first_rows_frequency_check": "WITH "
        + _frequency_check(check, plain, "SELECT text FROM documents ORDER BY doc_id LIMIT 50"),
        "align_by_row_id": f"""WITH {LD} SELECT row_id, sentiment AS actual,
            {GUESS} AS predicted FROM ld""",
        "align_by_content": f"WITH {_shifted()} SELECT row_id, actual, predicted FROM pairs",
        "align_auto": f"WITH {_shifted()} SELECT row_id, actual, predicted FROM pairs",
        "confusion_matrix": f"WITH {ROWS} SELECT actual, predicted, count FROM cells",
        "confusion_table": f"""WITH {ROWS} SELECT actual,
            sum(count) FILTER (predicted = 'negative')::BIGINT AS negative,
            sum(count) FILTER (predicted = 'neutral')::BIGINT AS neutral,
            sum(count) FILTER (predicted = 'positive')::BIGINT AS positive
            FROM cells GROUP BY actual""",
        "classification_report": f"WITH {ROWS}, {_report_of()} {REPORT}",
        "metric_averages": f"""WITH {ROWS}, {_report_of()} SELECT
            round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
            round(avg(f1), 6) AS f1_macro,
            round(sum(precision * support) / sum(support), 6) AS precision_weighted,
            round(sum(recall * support) / sum(support), 6) AS recall_weighted,
            round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM rep""",
        "accuracy": f"""WITH {ROWS} SELECT count(*) AS samples_compared,
            round(avg(CASE WHEN actual = predicted THEN 1::DOUBLE ELSE 0 END), 6) AS accuracy
            FROM pairs""",
        "validation": f"WITH {_shifted()}, {_report_of()} {REPORT}",
        "label_distribution": f"""WITH {DOCS}, p AS (SELECT grp AS category,
              {GUESS} AS predicted_sentiment FROM docs)
            SELECT category, predicted_sentiment, count(*) AS count FROM p
            GROUP BY GROUPING SETS ((category, predicted_sentiment), (predicted_sentiment))""",
        "document_frequency": f"""WITH {DOCS}, {_bigrams('docs')}
            SELECT term, df, cf FROM stats, n WHERE {BIGRAM_CUT}""",
        "most_frequent_terms": f"""WITH {DOCS}, {_tf('docs', _model_words('text'))}
            SELECT term, df, cf FROM stats ORDER BY cf DESC, md5(term) LIMIT 1000""",
        "tfidf_word": f"""WITH {DOCS}, {_tf('docs', _model_words('text'))},
            {_weights('true', False)}
            SELECT row_id, term, round(weight, 6) AS weight FROM tfidf""",
        "tfidf_bigram": f"""WITH {DOCS}, {_bigrams('docs')}, {_weights(BIGRAM_CUT, True)}
            SELECT row_id, term, round(weight, 6) AS weight FROM tfidf""",
        "tfidf_char": f"WITH {DOCS}, {_characters('docs')}, {_weights('df >= 2', True)} {SUMMARY}",
        "tfidf_union": f"""WITH words AS (WITH {DOCS}, {_bigrams('docs')},
              {_weights(BIGRAM_CUT, True)} {union_part} tfidf),
            chars AS (WITH {DOCS}, {_characters('docs')}, {_weights('df >= 2', True)}
              SELECT 'char' AS part, weight FROM tfidf)
            SELECT part, count(*) AS features, round(sum(weight), 2) AS weight_sum
            FROM (SELECT * FROM words UNION ALL SELECT * FROM chars) GROUP BY part""",
        "balanced_weights": f"""WITH {LD}, c AS (SELECT sentiment AS label,
              count(*) AS class_rows FROM ld GROUP BY ALL)
            SELECT label, class_rows, round((SELECT sum(class_rows) FROM c)::DOUBLE
              / ((SELECT count(*) FROM c) * class_rows), 6) AS class_weight FROM c""",
        "linear_scoring_matrix": f"""WITH {_scores()}
            SELECT row_id, negative, neutral, positive FROM scores""",
        "linear_scoring": f"""WITH {_scores()}
            SELECT row_id, {BEST} AS predicted_sentiment FROM scores""",
        "linear_confusion": f"""WITH {_scores()}, pairs AS (SELECT sentiment AS actual,
              {BEST} AS predicted FROM scores JOIN ld USING (row_id)),
            found AS (SELECT actual, predicted, count(*) AS count FROM pairs GROUP BY ALL)
            SELECT a.c AS actual, p.c AS predicted, coalesce(f.count, 0) AS count
            FROM {SENTIMENTS} a(c) CROSS JOIN {SENTIMENTS} p(c)
            LEFT JOIN found f ON f.actual = a.c AND f.predicted = p.c""",
        "external_model": f"""WITH {DOCS} SELECT grp AS "group",
            CASE WHEN length(text) < 600 THEN 'negative' WHEN length(text) < 1200
              THEN 'neutral' ELSE 'positive' END AS predicted_sentiment, count(*) AS count
            FROM docs GROUP BY ALL""",
        "run_speedup": f"WITH {EXPERIMENTS} SELECT *, {SPEEDUP} FROM runs",
        "run_series": f"""WITH {EXPERIMENTS}
            SELECT max_docs, chunk_size, elapsed_seconds FROM runs""",
        "run_table": f"""WITH {EXPERIMENTS} SELECT max_docs,
            max(elapsed_seconds) FILTER (chunk_size = 500) AS "500",
            max(elapsed_seconds) FILTER (chunk_size = 1000) AS "1000",
            max(elapsed_seconds) FILTER (chunk_size = 1500) AS "1500",
            max(elapsed_seconds) FILTER (chunk_size = 2000) AS "2000"
            FROM runs GROUP BY max_docs""",
        "candidate_selection": f"""WITH {LD}, guesses AS (
              SELECT 0 AS i, 'length' AS m, sentiment AS a, {GUESS} AS p FROM ld
              UNION ALL SELECT 1, 'language', sentiment,
                CASE lang WHEN 'de' THEN 'negative' ELSE 'positive' END FROM ld
              UNION ALL SELECT 2, 'constant', sentiment, 'positive' FROM ld),
            per AS (SELECT i, m, c,
                count(*) FILTER (a = c AND p = c)::DOUBLE AS tp,
                count(*) FILTER (a = c) + count(*) FILTER (p = c) AS both_
              FROM guesses, {SENTIMENTS} s(c) GROUP BY ALL),
            f AS (SELECT i, m, avg(coalesce(2 * tp / nullif(both_, 0), 0)) AS f1,
                sum(tp) AS hits FROM per GROUP BY ALL)
            SELECT i AS candidate_index, m AS model_name,
              round(hits / (SELECT count(*) FROM ld), 6) AS accuracy,
              round(f1, 6) AS f1_macro
            FROM f ORDER BY 3 DESC, 4 DESC, 1 LIMIT 1""",
        "csv_roundtrip": f"""WITH {DOCS} SELECT row_id, grp AS "group", text,
            {GUESS} AS predicted_sentiment FROM docs""",
        "parquet_roundtrip": f"""WITH {DOCS} SELECT row_id, grp AS "group", text,
            {GUESS} AS predicted_sentiment FROM docs""",
        "report_roundtrip": f"""WITH {_examples()}, e AS (SELECT sentiment, term,
              count(*) AS examples FROM ex WHERE example_rank <= 5 GROUP BY ALL)
            SELECT sentiment, rank, term, count, examples
            FROM ranked JOIN e USING (sentiment, term) WHERE rank <= 20""",
        "group_report_roundtrip": f"""WITH {_group_terms()}
            SELECT grp AS "group", sentiment, term, count, rank FROM ranked WHERE rank <= 20""",
        "csv_sources": """SELECT doc_id AS row_id, coalesce(text, '') AS text,
              CASE WHEN n_chars % 5 IN (0, 1) THEN 'negative' WHEN n_chars % 5 = 2
                THEN 'neutral' ELSE 'positive' END AS label,
              'articles' AS category, 'documents' AS source_dataset FROM documents
            UNION ALL SELECT doc_id, coalesce(text, ''), NULL, 'plain', 'documents'
            FROM documents""",
        "chart_labels": f"""WITH {DOCS} SELECT {GUESS} AS predicted_sentiment, count(*) AS count
            FROM docs GROUP BY ALL""",
        "saved_model": f"""WITH {LD} SELECT count(*) AS documents, count(*) AS same FROM ld""",
        "statistics_roundtrip": f"""WITH {_terms()} SELECT sentiment, term, count FROM counts
            ORDER BY count DESC, term, sentiment LIMIT 50""",
        "validation_roundtrip": f"""WITH {_shifted()}, t AS (
              SELECT count(*) AS token_total, count(DISTINCT term) AS unique_terms FROM (
                SELECT unnest({check}) AS term FROM documents)),
            c AS (SELECT term, count(*) AS n FROM (
                SELECT unnest({check}) AS term FROM documents) GROUP BY term)
            SELECT (SELECT count(*) FROM documents) AS checked_rows, unique_terms, token_total,
              (SELECT max(n) FROM c) AS highest_count,
              (SELECT count(*) FROM pairs) AS samples_compared,
              (SELECT round(avg(CASE WHEN actual = predicted THEN 1::DOUBLE ELSE 0 END), 6)
               FROM pairs) AS accuracy,
              (SELECT count(*) FROM pairs) AS matrix_total,
              (SELECT count(*) FROM pairs) AS support,
              (SELECT round(avg(CASE WHEN actual = predicted THEN 1::DOUBLE ELSE 0 END), 6)
               FROM pairs) AS weighted_recall FROM t""",
        "split_roundtrip": f"""WITH {LD}, s AS (SELECT sentiment,
              CASE WHEN row_number() OVER (PARTITION BY sentiment ORDER BY {SHUFFLE})
                <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY sentiment))
                THEN 'test' ELSE 'train' END AS split FROM ld)
            SELECT split, sentiment, count(*) AS count FROM s GROUP BY ALL""",
        "runs_roundtrip": f"""WITH {EXPERIMENTS} SELECT max_docs, chunk_size, workers,
            elapsed_seconds, processed_docs, {SPEEDUP} FROM runs""",
        "chart_runtime": f"""WITH {EXPERIMENTS}
            SELECT max_docs, chunk_size, elapsed_seconds FROM runs""",
        "chart_speedup": f"""WITH {EXPERIMENTS} SELECT max_docs, chunk_size, {SPEEDUP} FROM runs""",
        "chart_confusion": f"WITH {ROWS} SELECT actual, predicted, count FROM cells",
        **{
            f"chart_top_{name}": f"""WITH {_group_terms()}, merged AS (
              SELECT sentiment, term, sum(count)::BIGINT AS count FROM ranked
              WHERE rank <= 20 AND sentiment = '{name}' GROUP BY ALL)
            SELECT *, row_number() OVER (ORDER BY count DESC, term) AS rank FROM merged
            QUALIFY rank <= 10"""
            for name in ("positive", "negative")
        },
        "bounded_top_terms": f"""WITH {_group_terms()}, lists AS (SELECT * FROM ranked WHERE rank <= 20),
            ends AS (SELECT sentiment, grp, CASE WHEN count(*) >= 20 THEN min(count) ELSE 0 END AS last
                     FROM lists GROUP BY ALL),
            totals AS (SELECT sentiment, sum(last) AS unseen FROM ends GROUP BY sentiment),
            bounds AS (SELECT lists.sentiment, term, sum(count)::BIGINT AS lower,
                              (sum(count) - sum(last))::BIGINT AS most
                       FROM lists JOIN ends ON lists.sentiment = ends.sentiment
                         AND lists.grp IS NOT DISTINCT FROM ends.grp GROUP BY ALL),
            whole AS (SELECT sentiment, term, sum(count)::BIGINT AS count FROM counts GROUP BY ALL),
            best AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY count DESC, term) AS rank
                     FROM whole QUALIFY rank <= 10)
            SELECT sentiment, term, coalesce(lower, 0) AS lower,
                   (coalesce(most, 0) + unseen)::BIGINT AS upper, count, rank
            FROM best JOIN totals USING (sentiment) LEFT JOIN bounds USING (sentiment, term)""",
        "distinct_term_sketches": f"""WITH {_terms()}
            SELECT sentiment, count(*) AS exact, true AS within_error FROM counts GROUP BY sentiment
            UNION ALL SELECT 'all', count(DISTINCT term), true FROM counts""",
        "ground_truth_validation": f"""WITH {LD}, pairs AS (
              SELECT {GUESS} AS predicted, coalesce(l.sentiment, 'neutral') AS actual
              FROM documents d LEFT JOIN (SELECT row_id, sentiment FROM ld) l ON l.row_id = d.doc_id),
            {_report_of()} {REPORT}""",
        "held_out_report": f"""WITH {_scores()}, split AS (SELECT row_id, sentiment AS actual,
              row_number() OVER (PARTITION BY sentiment ORDER BY {SHUFFLE})
                <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY sentiment)) AS test FROM ld),
            pairs AS (SELECT actual, {BEST} AS predicted FROM split JOIN scores USING (row_id)
                      WHERE test), {_report_of()} {REPORT}""",
        "run_summary": """SELECT count(*) AS processed_docs, 20::BIGINT AS top_n, true AS timed
            FROM documents""",
        "run_label_counts": f"""WITH {_scores()}, p AS (SELECT coalesce(grp, 'unknown') AS "group",
              {BEST} AS predicted_sentiment FROM scores JOIN docs USING (row_id))
            SELECT "group", predicted_sentiment, count(*) AS count FROM p
            GROUP BY GROUPING SETS (("group", predicted_sentiment), (predicted_sentiment))""",
        "scored_sources": f"""WITH {_scores().replace(DOCS, _SOURCES)}, p AS (
              SELECT grp AS category, {BEST} AS predicted_sentiment FROM scores JOIN docs USING (row_id))
            SELECT category, predicted_sentiment, count(*) AS count FROM p
            GROUP BY GROUPING SETS ((category, predicted_sentiment), (predicted_sentiment))""",
        "training_metadata": f"""WITH {ROWS}, {_report_of()}
            SELECT 'baseline' AS selected_candidate, (SELECT count(*) FROM ld) AS total_rows,
              (SELECT count(*) FROM ld WHERE sentiment = 'negative') AS negative,
              (SELECT count(*) FROM ld WHERE sentiment = 'neutral') AS neutral,
              (SELECT count(*) FROM ld WHERE sentiment = 'positive') AS positive,
              (SELECT round(avg((actual = predicted)::INT), 6) FROM pairs) AS accuracy,
              (SELECT round(avg(f1), 6) FROM (SELECT c.c, coalesce(f1, 0) AS f1
                 FROM {SENTIMENTS} c(c) LEFT JOIN rep ON class = c.c)) AS f1_macro,
              9::BIGINT AS cells, 42::BIGINT AS random_state, true AS timed""",
    }
