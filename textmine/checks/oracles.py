"""SQL for DuckDB that gives the same rows as the registered queries, from the same tables."""

from __future__ import annotations

# The 181 default English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()

WORD_LIST = "[" + ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS) + "]"

# White space as the tokeniser sees it.
SPACES = r"[ \t\n\x0B\f\r]+"


def _cleaned(text: str) -> str:
    for pattern in (r"(?s)<.*?>", r"\n", "[[:punct:]]", r"\d"):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return text


def _words(text: str) -> str:
    return (
        f"list_filter(string_split_regex(lower({text}), '{SPACES}'), "
        "lambda w: length(w) >= 2 OR strlen(w) = 4)"
    )


def _content_words(text: str) -> str:
    return f"list_filter({_words(text)}, lambda w: NOT list_contains({WORD_LIST}, w))"


CORPORA = {
    "language": "SELECT doc_id, text, lang AS cat FROM documents",
    "quality": "SELECT doc_id, text, quality::VARCHAR AS cat FROM documents JOIN labels USING (doc_id)",
    "source": "SELECT doc_id, text, source AS cat FROM documents",
    "role": "SELECT conv_id || ':' || turn AS doc_id, text, role AS cat FROM conversations",
}


def _corpus(name: str) -> str:
    """Common tables up to TF-IDF weights; fold -1 is the test part."""
    return f"""
corpus AS (SELECT doc_id, cat, {_cleaned("text")} AS text,
           ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT AS h FROM ({CORPORA[name]})),
docs AS (SELECT doc_id, cat, CASE WHEN h % 10 < 7 THEN (h // 10) % 3 ELSE -1 END AS fold FROM corpus),
tokens AS (SELECT doc_id, unnest({_content_words("text")}) AS term FROM corpus),
counts AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY doc_id, term),
vocabulary AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf,
               ln(((SELECT count(*) FROM corpus) + 1) / (count(*) + 1)) AS idf
               FROM counts GROUP BY term HAVING count(*) >= 5),
weights AS (SELECT doc_id, term, tf, tf * idf AS w FROM counts JOIN vocabulary USING (term))"""


def _models(name: str, holdouts: str, grid: str) -> str:
    """A dense model per held-out fold and smoothing, and the class each document gets."""
    return f"""
{_corpus(name)},
holdouts AS (SELECT unnest({holdouts}) AS holdout),
grid AS (SELECT unnest({grid}) AS s),
training AS (SELECT holdout, doc_id, cat FROM docs, holdouts WHERE fold NOT IN (-1, holdout)),
classes AS (SELECT holdout, cat, count(*) AS n FROM training GROUP BY holdout, cat),
priors AS (SELECT holdout, s, cat, n,
           ln(n + s) - ln(sum(n) OVER (PARTITION BY holdout, s)
                          + s * count(*) OVER (PARTITION BY holdout, s)) AS prior
           FROM classes, grid),
seen AS (SELECT holdout, cat, term, sum(w) AS w FROM training JOIN weights USING (doc_id)
         GROUP BY holdout, cat, term),
totals AS (SELECT holdout, cat, sum(w) AS w FROM seen GROUP BY holdout, cat),
theta AS (SELECT p.holdout, p.s, p.cat, v.term,
          ln(coalesce(seen.w, 0) + p.s)
            - ln(totals.w + p.s * (SELECT count(*) FROM vocabulary)) AS weight
          FROM priors p CROSS JOIN vocabulary v
          JOIN totals ON totals.holdout = p.holdout AND totals.cat = p.cat
          LEFT JOIN seen ON seen.holdout = p.holdout AND seen.cat = p.cat AND seen.term = v.term),
sums AS (SELECT d.doc_id, t.holdout, t.s, t.cat, sum(w.w * t.weight) AS score
         FROM docs d JOIN weights w ON w.doc_id = d.doc_id
         JOIN theta t ON t.term = w.term AND t.holdout = d.fold
         GROUP BY d.doc_id, t.holdout, t.s, t.cat),
scored AS (SELECT d.doc_id, d.cat, d.fold, p.s, p.cat AS pred_cat, p.n,
           p.prior + coalesce(sums.score, 0) AS score
           FROM docs d JOIN priors p ON p.holdout = d.fold
           LEFT JOIN sums ON sums.doc_id = d.doc_id AND sums.holdout = p.holdout
                         AND sums.s = p.s AND sums.cat = p.cat),
predictions AS (SELECT * FROM scored QUALIFY row_number()
                OVER (PARTITION BY doc_id, s ORDER BY score DESC, n DESC, pred_cat) = 1)"""


def _final(name: str) -> str:
    return _models(name, "[-1]", "[1.0]")


def _metrics(by: str, where: str = "TRUE") -> str:
    """Metrics per group from the predictions, class by class."""
    keys = by + ", " if by else ""
    same = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in by.split(",")) if by else "TRUE"
    group = f"GROUP BY {by}" if by else ""
    return f"""
judged AS (SELECT * FROM predictions WHERE {where}),
actual AS (SELECT {keys} cat AS c, count(*) AS sup,
           count(*) FILTER (WHERE cat = pred_cat) AS tp FROM judged GROUP BY {keys} cat),
claimed AS (SELECT {keys} pred_cat AS c, count(*) AS pp FROM judged GROUP BY {keys} pred_cat),
per_class AS (SELECT a.*, coalesce(b.pp, 0) AS pp
              FROM actual a LEFT JOIN claimed b ON a.c = b.c AND {same}),
metrics AS (SELECT {keys}
            sum(sup * (CASE WHEN tp = 0 THEN 0 ELSE 2.0 * tp / (sup + pp) END)) / sum(sup) AS f1,
            sum(sup * (CASE WHEN pp = 0 THEN 0 ELSE tp / pp END)) / sum(sup) AS "weightedPrecision",
            sum(sup * (tp / sup)) / sum(sup) AS "weightedRecall",
            sum(tp) / sum(sup) AS accuracy FROM per_class {group})"""


def _predict(name: str) -> str:
    return f"""WITH {_final(name)}
SELECT doc_id, cat, pred_cat, round(score, 3) AS score FROM predictions"""


def _labels(name: str) -> str:
    return f"WITH {_final(name)} SELECT doc_id, cat, pred_cat FROM predictions"


def _confusion(name: str) -> str:
    return f"""WITH {_final(name)}
SELECT cat, pred_cat, count(*) AS n FROM predictions GROUP BY cat, pred_cat"""


def _eval(name: str, *columns: str, where: str = "TRUE") -> str:
    chosen = ", ".join(f'round("{c}", 4) AS "{c}"' for c in columns)
    return f"WITH {_final(name)}, {_metrics('', where)} SELECT {chosen} FROM metrics"


ALL_METRICS = ("f1", "weightedPrecision", "weightedRecall", "accuracy")


def _cv(name: str) -> str:
    return f"""WITH {_models(name, "[0, 1, 2]", "[1.0, 0.5]")}, {_metrics("s, fold")}
SELECT s::DOUBLE AS smoothing, round(avg(f1), 4) AS avg_metric,
       round(stddev_pop(f1), 4) AS std_metric FROM metrics GROUP BY s"""


def _cv_best(name: str) -> str:
    return f"""WITH {_models(name, "[-1, 0, 1, 2]", "[1.0, 0.5]")}, {_metrics("s, fold")},
best AS (SELECT s FROM metrics WHERE fold <> -1 GROUP BY s
         ORDER BY round(avg(f1), 12) DESC, s DESC LIMIT 1)
SELECT s::DOUBLE AS smoothing, round(f1, 4) AS f1 FROM metrics JOIN best USING (s) WHERE fold = -1"""


PAGES = "SELECT page_id, {} AS text FROM pages"
TFIDF = f"""WITH {_corpus("language")}
SELECT doc_id, term, round(w, 4) AS tfidf FROM weights"""
JOINED = "coalesce(url, '') || ' ' || coalesce(html, '')"


def oracles() -> dict[str, str]:
    corpus = _corpus("language")
    words = """WITH {corpus}, w AS (SELECT doc_id, {words} AS w FROM corpus)
SELECT doc_id, len(w)::INTEGER AS n_words, coalesce(array_to_string(w, ' '), '') AS words FROM w"""
    return {
        "row_count": "SELECT count(*) AS n FROM documents",
        "count_by_category": "SELECT lang AS cat, count(*) AS n FROM documents GROUP BY lang",
        "preview": "SELECT doc_id, text, lang AS cat FROM documents ORDER BY doc_id LIMIT 2",
        "describe_schema": """
SELECT 'doc_id' AS name, 'bigint' AS type, count(doc_id) AS present FROM documents
UNION ALL SELECT 'text', 'string', NULL
UNION ALL SELECT 'cat', 'string', NULL""",
        "concat_fields": PAGES.format(JOINED),
        "project_rename": "SELECT text, lang AS cat FROM documents",
        "clean_tags": PAGES.format("regexp_replace(html, '(?s)<.*?>', ' ', 'g')"),
        "clean_newlines": PAGES.format("replace(html, chr(10), ' ')"),
        "clean_punct": PAGES.format("regexp_replace(html, '[[:punct:]]', ' ', 'g')"),
        "clean_digits": PAGES.format(r"regexp_replace(html, '\d', ' ', 'g')"),
        "clean_text": f"WITH {corpus} SELECT doc_id, text, cat FROM corpus",
        "clean_posts": f"""
SELECT page_id, {_cleaned(JOINED)} AS text, regexp_extract(html, 'lang="([a-z]+)"', 1) AS cat
FROM pages""",
        "tokenize": words.format(corpus=corpus, words=_words("text")),
        "remove_stopwords": words.format(corpus=corpus, words=_content_words("text")),
        "stop_words": f"""WITH {corpus},
found AS (SELECT unnest({_words("text")}) AS word FROM corpus)
SELECT word, (SELECT count(*) FROM found WHERE found.word = listed.word) AS n
FROM (SELECT unnest({WORD_LIST}) AS word) listed""",
        "doc_frequency": f"WITH {corpus} SELECT term, df, cf FROM vocabulary",
        "top_terms": f"""WITH {corpus}
SELECT term, df, cf FROM vocabulary ORDER BY cf DESC, term LIMIT 100""",
        "vocabulary_size": f"""WITH {corpus}
SELECT term, df, cf FROM vocabulary ORDER BY cf DESC, term LIMIT 500""",
        "term_counts": f"WITH {corpus} SELECT doc_id, term, tf FROM weights",
        "idf_weights": f"WITH {corpus} SELECT term, df, round(idf, 4) AS idf FROM vocabulary",
        "tfidf": TFIDF,
        "vector_tfidf": TFIDF,
        "dictionary_tfidf": TFIDF,
        "ml_tfidf": TFIDF,
        "hash_split": f"""WITH {corpus}
SELECT doc_id, CASE WHEN fold = -1 THEN 'test' ELSE 'training' END AS part FROM docs""",
        "label_index": """
SELECT cat, n, (row_number() OVER (ORDER BY n DESC, cat) - 1)::DOUBLE AS label
FROM (SELECT lang AS cat, count(*) AS n FROM documents GROUP BY lang)""",
        "string_index": """
WITH classes AS (SELECT source AS cat, count(*) AS n FROM documents GROUP BY source),
ranked AS (SELECT cat, (row_number() OVER (ORDER BY n DESC, cat) - 1)::DOUBLE AS label FROM classes)
SELECT doc_id, cat, label FROM documents JOIN ranked ON cat = source""",
        "index_to_string": """
WITH classes AS (SELECT source AS cat, count(*) AS n FROM documents GROUP BY source),
ranked AS (SELECT cat, (row_number() OVER (ORDER BY n DESC, cat) - 1)::DOUBLE AS label FROM classes)
SELECT doc_id, label, cat FROM documents JOIN ranked ON cat = source""",
        "binary_label": """
SELECT doc_id, lang AS cat, CASE WHEN lang IN ('en') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
FROM documents""",
        "nb_priors": f"WITH {_final('language')} SELECT cat, round(prior, 4) AS prior FROM priors",
        "nb_term_weights": f"""WITH {_final("language")}
SELECT cat, term, round(weight, 4) AS weight FROM theta""",
        "nb_predict": _predict("language"),
        "nb_predict_quality": _predict("quality"),
        "nb_predict_role": _predict("role"),
        "nb_predict_source": _predict("source"),
        "nb_predict_blocks": _predict("source"),
        "nb_saved": _predict("source"),
        "prediction_pairs": f"WITH {_final('quality')} SELECT cat, pred_cat FROM predictions",
        "confusion_long": _confusion("language"),
        "confusion_long_quality": _confusion("quality"),
        "confusion_wide": f"""WITH {_final("language")}, n AS (
SELECT cat, pred_cat, count(*) AS n FROM predictions GROUP BY cat, pred_cat)
SELECT pred_cat,
       sum(n) FILTER (WHERE cat = 'de')::BIGINT AS de, sum(n) FILTER (WHERE cat = 'en')::BIGINT AS en,
       sum(n) FILTER (WHERE cat = 'es')::BIGINT AS es, sum(n) FILTER (WHERE cat = 'fr')::BIGINT AS fr
FROM n GROUP BY pred_cat""",
        "confusion_table": f"""WITH {_final("language")}
SELECT cat, count(*) FILTER (WHERE pred_cat = 'de') AS de,
       count(*) FILTER (WHERE pred_cat = 'en') AS en, count(*) FILTER (WHERE pred_cat = 'es') AS es,
       count(*) FILTER (WHERE pred_cat = 'fr') AS fr FROM predictions GROUP BY cat""",
        "confusion_table_quality": f"""WITH {_final("quality")}
SELECT cat, count(*) FILTER (WHERE pred_cat = '0') AS "0",
       count(*) FILTER (WHERE pred_cat = '1') AS "1" FROM predictions GROUP BY cat""",
        "eval_f1": _eval("language", "f1"),
        "eval_all": _eval("language", *ALL_METRICS),
        "eval_all_quality": _eval("quality", *ALL_METRICS),
        "eval_all_role": _eval("role", *ALL_METRICS),
        "eval_without_class": _eval("language", "f1", where="cat <> 'en'"),
        "eval_without_class_quality": _eval("quality", "f1", where="cat <> '1'"),
        "cv_metrics": _cv("language"),
        "cv_metrics_quality": _cv("quality"),
        "cv_metrics_role": _cv("role"),
        "cv_best": _cv_best("language"),
        "cv_best_quality": _cv_best("quality"),
        "ml_cv_metrics": _cv("language"),
        "ml_cv_metrics_quality": _cv("quality"),
        "ml_predict": _labels("quality"),
        "ml_eval": _eval("quality", *ALL_METRICS),
        "csv_multiline": "SELECT doc_id, text, lang AS cat FROM documents",
        "csv_split": "SELECT doc_id, text, lang AS cat FROM documents",
        "csv_roundtrip": f"WITH {corpus} SELECT text, cat FROM corpus",
        "csv_preprocess": f"""
SELECT {_cleaned(JOINED)} AS text, regexp_extract(html, 'lang="([a-z]+)"', 1) AS cat FROM pages""",
        "parquet_roundtrip": TFIDF,
        "json_roundtrip": TFIDF,
        "model_roundtrip": _labels("quality"),
        "local_table": """
SELECT CASE lang WHEN 'de' THEN 'German' WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish'
       ELSE 'French' END AS name, count(*) AS n FROM documents GROUP BY lang""",
        "cached_count": "SELECT count(*) AS n, false AS still_cached FROM documents",
        "random_split": """
SELECT count(*)::BIGINT AS total, count(DISTINCT doc_id) AS keys, 0::BIGINT AS in_both, true AS share_holds
FROM documents""",
        "svc_certificate": f"""WITH {corpus}
SELECT count(*) AS n, TRUE AS bound_holds, TRUE AS near_optimum FROM docs WHERE fold <> -1""",
        "svc_checks": f"""WITH {corpus}
SELECT CASE WHEN cat = 'en' THEN 1.0 ELSE 0.0 END::DOUBLE AS label, count(*) AS n,
       count(DISTINCT doc_id) AS documents, count(*) AS judged, true AS better_than_chance
FROM docs WHERE fold = -1 GROUP BY label""",
        "csv_by_name": """
SELECT url AS "Title", html AS "Body", regexp_extract(html, 'lang="([a-z]+)"', 1) AS "Category" FROM pages""",
        "csv_nulls": """
SELECT doc_id::VARCHAR AS key, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE lang END AS text
FROM documents""",
        "csv_features": f"""WITH {corpus}
SELECT doc_id, count(term)::INTEGER AS n_terms, round(coalesce(sum(w), 0), 3) AS total
FROM corpus LEFT JOIN weights USING (doc_id) GROUP BY doc_id""",
    }
