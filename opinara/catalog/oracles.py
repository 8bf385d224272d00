"""The same results in SQL over the given tables, for checking.

Written for DuckDB. Common table expressions shared by several queries are kept as named
fragments and put together by :func:`_sql`. Left out are only queries whose result depends on
iterative fitting, on Spark's internal hash or on the clock.
"""

from __future__ import annotations

from opinara.catalog.queries import (
    DEMO_INTERCEPT, DEMO_WEIGHTS, SAMPLE_FRACTION, SAMPLE_PER_CLASS, SAMPLE_ROWS,
)
from opinara.functions.ranks import RANK_SPAN
from opinara.functions.stopwords import ENGLISH
from opinara.plans.studies import FRACTIONS

_BLANK = r"[ \t\n\x0B\f\r]"
_RUN = r"[^ \t\n\x0B\f\r]+"
_STOP = "[" + ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH) + "]"


def _rank(seed: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || doc_id::VARCHAR), 1, 15))::BIGINT"


# Fragments: name -> (fragments it reads, body).
_FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": (
        (),
        """SELECT doc_id, l.quality + 1 AS polarity, d.source AS title, d.text
           FROM documents d JOIN labels l USING (doc_id)""",
    ),
    "reviews": (
        ("raw",),
        f"""SELECT doc_id, polarity, lower(title) AS title, lower(text) AS text,
                   lower(title) || ' ' || lower(text) AS combined_text,
                   CASE WHEN polarity = 1 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label,
                   CASE WHEN {_rank("split-42")} < {int(0.2 * RANK_SPAN)}
                        THEN 'test' ELSE 'train' END AS split
            FROM raw
            WHERE doc_id IS NOT NULL AND polarity IS NOT NULL
              AND title IS NOT NULL AND text IS NOT NULL""",
    ),
    "articles": (
        (),
        """SELECT doc_id, lower(source) AS title, lower(text) AS text,
                  lower(source) || ' ' || lower(text) AS combined_text
           FROM documents
           WHERE doc_id IS NOT NULL AND source IS NOT NULL AND text IS NOT NULL""",
    ),
    "lengths": (
        ("articles",),
        f"""SELECT doc_id, length(combined_text)::INTEGER AS char_length,
                   len(regexp_extract_all(combined_text, '{_RUN}'))::INTEGER AS word_count,
                   length(title)::INTEGER AS title_len, length(text)::INTEGER AS text_len
            FROM articles""",
    ),
    "rules": (
        ("reviews",),
        """SELECT *, CASE WHEN prob >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
           FROM (SELECT *, least(length(text), 3000) / 3000.0::DOUBLE AS prob FROM reviews)""",
    ),
    "scored": (
        ("rules",),
        """SELECT prob AS score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::DOUBLE AS pos,
                  sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)::DOUBLE AS neg
           FROM rules GROUP BY prob""",
    ),
    "ranked": (
        ("scored",),
        """SELECT *, sum(pos) OVER (ORDER BY score DESC) AS pos_upto,
                  sum(neg) OVER (ORDER BY score DESC) AS neg_upto,
                  sum(pos) OVER () AS positives, sum(neg) OVER () AS negatives
           FROM scored""",
    ),
    "article_tokens": (
        ("articles",),
        f"""SELECT doc_id, CASE WHEN body = '' AND combined_text <> '' THEN []::VARCHAR[]
                   ELSE string_split_regex(body, '{_BLANK}') END AS tokens
            FROM (SELECT *, regexp_replace(combined_text, '{_BLANK}+\\z', '') AS body
                  FROM articles)""",
    ),
    "article_kept": (
        ("article_tokens",),
        f"""SELECT doc_id, list_filter(tokens, lambda t: NOT list_contains({_STOP}, t)) AS kept
            FROM article_tokens""",
    ),
    "article_terms": (("article_kept",), "SELECT doc_id, unnest(kept) AS term FROM article_kept"),
    "article_vocabulary": (
        ("article_terms",),
        """SELECT row_number() OVER (ORDER BY cnt DESC, term) - 1 AS idx, term, cnt, df
           FROM (SELECT term, count(*) AS cnt, count(DISTINCT doc_id) AS df
                 FROM article_terms GROUP BY term HAVING count(DISTINCT doc_id) >= 5
                 ORDER BY cnt DESC, term LIMIT 65536)""",
    ),
    "article_bigrams": (
        ("article_kept",),
        """SELECT doc_id, CASE WHEN len(kept) >= 2
                  THEN list_transform(range(1, len(kept)), lambda i: kept[i] || ' ' || kept[i + 1])
                  ELSE []::VARCHAR[] END AS grams
           FROM article_kept""",
    ),
    "bigram_vocabulary": (
        ("article_bigrams",),
        """SELECT row_number() OVER (ORDER BY cnt DESC, term) - 1 AS idx, term, cnt, df
           FROM (SELECT term, count(*) AS cnt, count(DISTINCT doc_id) AS df
                 FROM (SELECT doc_id, unnest(grams) AS term FROM article_bigrams)
                 GROUP BY term HAVING count(DISTINCT doc_id) >= 5
                 ORDER BY cnt DESC, term LIMIT 65536)""",
    ),
    "review_terms": (("review_kept",), "SELECT doc_id, label, split, unnest(kept) AS term FROM review_kept"),
    "review_kept": (
        ("reviews",),
        f"""SELECT doc_id, label, split, list_filter(
                   CASE WHEN body = '' THEN []::VARCHAR[]
                   ELSE string_split_regex(body, '{_BLANK}') END,
                   lambda t: NOT list_contains({_STOP}, t)) AS kept
            FROM (SELECT *, regexp_replace(combined_text, '{_BLANK}+\\z', '') AS body FROM reviews)""",
    ),
    "nb_vocabulary": (
        ("review_terms",),
        """SELECT row_number() OVER (ORDER BY cnt DESC, term) - 1 AS idx, term
           FROM (SELECT term, count(*) AS cnt FROM review_terms WHERE split = 'train'
                 GROUP BY term HAVING count(DISTINCT doc_id) >= 5
                 ORDER BY cnt DESC, term LIMIT 65536)""",
    ),
    "nb_cells": (
        ("nb_vocabulary", "review_terms"),
        """SELECT c.label, v.idx, v.term, coalesce(s.tf, 0) AS tf
           FROM nb_vocabulary v
           CROSS JOIN (SELECT unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS label) c
           LEFT JOIN (SELECT label, term, count(*) AS tf FROM review_terms
                      WHERE split = 'train' GROUP BY label, term) s
             ON s.label = c.label AND s.term = v.term""",
    ),
    "nb_priors": (
        ("reviews",),
        """SELECT label, ln(count(*) + 1.0) - ln(sum(count(*)) OVER () + 2.0) AS pi
           FROM reviews WHERE split = 'train' GROUP BY label""",
    ),
    "nb_model": (
        ("nb_cells", "nb_priors"),
        """SELECT label, idx, term, tf, pi, ln(tf + 1.0::DOUBLE)
                  - ln((sum(tf) OVER (PARTITION BY label) + count(*) OVER (PARTITION BY label))
                       ::DOUBLE) AS theta
           FROM nb_cells JOIN nb_priors USING (label)""",
    ),
    "nb_margin": (
        ("nb_model",),
        """SELECT term, sum(CASE WHEN label = 1 THEN theta ELSE -theta END) AS weight
           FROM nb_model GROUP BY term""",
    ),
    "nb_intercept": (
        ("nb_priors",),
        "SELECT sum(CASE WHEN label = 1 THEN pi ELSE -pi END) AS intercept FROM nb_priors",
    ),
    "nb_scored": (
        ("reviews", "review_terms", "nb_margin", "nb_intercept"),
        """SELECT doc_id, label, split, combined_text,
                  1.0 / (1.0 + exp(least(-margin, 700.0))) AS prob,
                  CASE WHEN margin > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
           FROM (SELECT r.*, coalesce(e.evidence, 0.0) + i.intercept AS margin
                 FROM reviews r CROSS JOIN nb_intercept i
                 LEFT JOIN (SELECT doc_id, sum(weight) AS evidence
                            FROM review_terms JOIN nb_margin USING (term) GROUP BY doc_id) e
                   USING (doc_id))""",
    ),
    # The stream scores the text alone, without the title, of all documents.
    "stream_terms": (
        (),
        f"""SELECT doc_id, unnest(string_split_regex(
                   regexp_replace(lower(text), '{_BLANK}+\\z', ''), '{_BLANK}')) AS term
            FROM documents WHERE len(regexp_extract_all(text, '{_RUN}')) > 0""",
    ),
    "stream_scored": (
        ("stream_terms", "nb_margin", "nb_intercept"),
        """SELECT doc_id, 1.0 / (1.0 + exp(least(-margin, 700.0))) AS prob, margin
           FROM (SELECT doc_id, coalesce(sum(weight), 0.0) + any_value(intercept) AS margin
                 FROM stream_terms LEFT JOIN nb_margin USING (term) CROSS JOIN nb_intercept
                 GROUP BY doc_id)""",
    ),
    "rule_rows": (
        ("reviews",),
        """SELECT seq, model, feature_type, label, prob,
                  CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS prediction
           FROM (SELECT 0 AS seq, 'long_text' AS model, 'characters' AS feature_type, label,
                        least(length(text), 3000) / 3000.0::DOUBLE AS prob FROM reviews
                 UNION ALL
                 SELECT 1, 'long_text', 'words', label,
                        least(len(string_split(text, ' ')), 500) / 500.0::DOUBLE FROM reviews
                 UNION ALL
                 SELECT 2, 'short_text', 'characters', label,
                        1.0::DOUBLE - least(length(text), 3000) / 3000.0::DOUBLE FROM reviews)""",
    ),
    "rule_cells": (
        ("rule_rows",),
        """SELECT seq, model, feature_type,
                  sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
                  sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS fp,
                  sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn,
                  sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS fn
           FROM rule_rows GROUP BY seq, model, feature_type""",
    ),
    "rule_auc": (
        ("rule_rows",),
        """SELECT seq, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc
           FROM (SELECT *, sum(neg) OVER (PARTITION BY seq ORDER BY prob) - neg AS below
                 FROM (SELECT seq, prob,
                              sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::DOUBLE AS pos,
                              sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)::DOUBLE AS neg
                       FROM rule_rows GROUP BY seq, prob))
           GROUP BY seq""",
    ),
}


_FRAGMENTS["partly"] = (
    ("rules",),
    """SELECT r.label, r.prediction, coalesce(s.score, '-inf'::DOUBLE) AS score
       FROM rules r LEFT JOIN (SELECT conv_id AS doc_id, max(turn) / 10.0::DOUBLE AS score
                               FROM conversations GROUP BY conv_id) s USING (doc_id)""",
)
_FRAGMENTS["gaps"] = (
    ("rules",),
    """SELECT r.doc_id, r.label, r.combined_text, CASE WHEN right(r.title, 1) IN ('0', '2', '4', '6', '8') THEN r.prediction END AS given,
              CASE WHEN right(r.title, 1) IN ('0', '2', '4', '6', '8') THEN r.prediction ELSE 1 - r.label END AS prediction,
              CASE WHEN s.turns % 3 = 0 THEN 'nan'::DOUBLE ELSE s.turns / 10.0::DOUBLE END AS prob
       FROM rules r LEFT JOIN (SELECT conv_id AS doc_id, max(turn) AS turns FROM conversations GROUP BY conv_id) s USING (doc_id)""",
)
_FRAGMENTS["gap_cells"] = (
    ("gaps",),
    """SELECT sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
              sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS fp,
              sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn,
              sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS fn FROM gaps""",
)
_FRAGMENTS["partly_scored"] = (
    ("partly",),
    """SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::DOUBLE AS pos,
              sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)::DOUBLE AS neg FROM partly GROUP BY score""",
)
_FRAGMENTS["partly_ranked"] = (
    ("partly_scored",),
    """SELECT *, sum(pos) OVER (ORDER BY score DESC) AS pos_upto, sum(neg) OVER (ORDER BY score DESC) AS neg_upto,
              sum(pos) OVER () AS positives, sum(neg) OVER () AS negatives FROM partly_scored""",
)
_FRAGMENTS["partly_cells"] = (
    ("partly",),
    """SELECT sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
              sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS fp,
              sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn,
              sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS fn FROM partly""",
)


def _weighted(cells: str, keys: str = "") -> str:
    """Accuracy and support-weighted precision, recall and F1 from tp, fp, tn, fn."""
    return f"""SELECT {keys}
        (tp + tn) / n AS accuracy,
        (s1 * p1 + s0 * p0) / n AS precision,
        (s1 * r1 + s0 * r0) / n AS recall,
        (s1 * CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END
         + s0 * CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END) / n AS f1
        FROM (SELECT *, tp + fp + tn + fn AS n, tp + fn AS s1, tn + fp AS s0,
                     CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p1,
                     CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r1,
                     CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p0,
                     CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS r0
              FROM {cells})"""


_FRAGMENTS["rule_metrics"] = (("rule_cells",), _weighted("rule_cells", "seq, model, feature_type,"))
_FRAGMENTS["partly_metrics"] = (("partly_cells",), _weighted("partly_cells"))
_FRAGMENTS["partly_auc"] = (
    ("partly_ranked",),
    "SELECT sum(pos * (negatives - neg_upto + 0.5 * neg)) / (any_value(positives) * any_value(negatives)) AS auc FROM partly_ranked",
)
_FRAGMENTS["rule_runs"] = (
    ("rule_metrics", "rule_auc"),
    "SELECT * FROM rule_metrics JOIN rule_auc USING (seq)",
)


def _nb_study(name: str, docs: tuple[tuple[str, ...], str], terms: tuple[tuple[str, ...], str]) -> None:
    """Fragments of several naive Bayes runs side by side, up to ``<name>_rows`` of the tested documents.

    ``docs`` gives ``seq, doc_id, label, part`` and ``terms`` gives ``seq, doc_id, term``. A run without vocabulary has no rows.
    """
    _FRAGMENTS[f"{name}_docs"], _FRAGMENTS[f"{name}_terms"] = docs, terms
    _FRAGMENTS[f"{name}_vocabulary"] = (
        (f"{name}_docs", f"{name}_terms"),
        f"""SELECT seq, term FROM {name}_terms JOIN {name}_docs USING (seq, doc_id) WHERE part = 'train'
            GROUP BY seq, term HAVING count(DISTINCT doc_id) >= 5
            QUALIFY row_number() OVER (PARTITION BY seq ORDER BY count(*) DESC, term) <= 65536""",
    )
    _FRAGMENTS[f"{name}_margin"] = (
        (f"{name}_vocabulary",),
        f"""SELECT seq, term, sum(CASE WHEN label = 1 THEN theta ELSE -theta END) AS weight
            FROM (SELECT seq, label, term, ln(tf + 1.0::DOUBLE) - ln((sum(tf) OVER both_ + count(*) OVER both_)::DOUBLE) AS theta
                  FROM (SELECT v.seq, c.label, v.term, coalesce(s.tf, 0) AS tf
                        FROM {name}_vocabulary v CROSS JOIN (SELECT unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS label) c
                        LEFT JOIN (SELECT seq, label, term, count(*) AS tf
                                   FROM {name}_terms JOIN {name}_docs USING (seq, doc_id)
                                   WHERE part = 'train' GROUP BY seq, label, term) s
                          ON s.seq = v.seq AND s.label = c.label AND s.term = v.term)
                  WINDOW both_ AS (PARTITION BY seq, label))
            GROUP BY seq, term""",
    )
    _FRAGMENTS[f"{name}_rows"] = (
        (f"{name}_margin",),
        f"""SELECT seq, label, 1.0 / (1.0 + exp(least(-margin, 700.0))) AS prob, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction
            FROM (SELECT d.seq, d.label, coalesce(e.evidence, 0.0) + i.intercept AS margin
                  FROM {name}_docs d
                  JOIN (SELECT seq, ln(sum(label) + 1.0) - ln(sum(1 - label) + 1.0) AS intercept
                        FROM {name}_docs WHERE part = 'train' AND seq IN (SELECT seq FROM {name}_vocabulary)
                        GROUP BY seq) i ON i.seq = d.seq
                  LEFT JOIN (SELECT t.seq, doc_id, sum(weight) AS evidence
                             FROM {name}_terms t JOIN {name}_margin m ON m.seq = t.seq AND m.term = t.term
                             GROUP BY t.seq, doc_id) e ON e.seq = d.seq AND e.doc_id = d.doc_id
                  WHERE d.part = 'test')""",
    )


_nb_study(
    "grid",
    (("reviews",), "SELECT unnest([0, 1]) AS seq, doc_id, label, split AS part FROM reviews"),
    (
        ("review_kept",),
        """SELECT 0 AS seq, doc_id, unnest(kept) AS term FROM review_kept
           UNION ALL SELECT 1, doc_id, unnest(list_transform(range(1, len(kept)), lambda i: kept[i] || ' ' || kept[i + 1]))
           FROM review_kept""",
    ),
)
for _name in ("rule_cells", "rule_metrics", "rule_auc", "rule_runs"):
    _needed, _body = _FRAGMENTS[_name]
    _own = _body.replace("rule_", "grid_").replace("seq, model, feature_type", "seq")
    _FRAGMENTS[_name.replace("rule", "grid")] = (tuple(n.replace("rule", "grid") for n in _needed), _own)
_nb_study(
    "scaling",
    (
        ("reviews",),
        f"""SELECT seq, doc_id, label, split AS part
            FROM reviews CROSS JOIN (SELECT unnest(range({len(FRACTIONS)})) AS seq)
            WHERE split = 'test' OR {_rank("42")} < ({[int(f * RANK_SPAN) for f in FRACTIONS]}::HUGEINT[])[seq + 1]""",
    ),
    (("review_terms",), f"SELECT unnest(range({len(FRACTIONS)})) AS seq, doc_id, term FROM review_terms"),
)


def _sql(body: str, *fragments: str) -> str:
    """Prefix ``body`` with the named fragments and all they read, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in _FRAGMENTS[name][0]:
                add(needed)
            ordered.append(name)

    for name in fragments:
        add(name)
    ctes = ",\n".join(f"{name} AS ({_FRAGMENTS[name][1]})" for name in ordered)
    return f"WITH {ctes}\n{body}" if ctes else body


def _binned(source: str, by: str, value: str, bins: int, *fragments: str) -> str:
    """Equal-width histogram of ``value`` per ``by`` over each series' own range."""
    return _sql(
        f"""SELECT {by}, f.bin::INTEGER AS bin,
                   round(low + f.bin * ((high - low) / {bins}.0::DOUBLE), 6) AS bin_start,
                   coalesce(b.cnt, 0)::BIGINT AS cnt
            FROM (SELECT {by}, low, high, unnest(range({bins})) AS bin FROM spans) f
            LEFT JOIN (SELECT {by}, least(floor((value - low)
                              / ((high - low) / {bins}.0::DOUBLE)), {bins - 1}) AS bin,
                              count(*) AS cnt
                       FROM entries JOIN spans USING ({by}) GROUP BY ALL) b
              USING ({by}, bin)""",
        *fragments,
    ).replace(
        "\nSELECT",
        f""",
entries AS (SELECT {by}, ({value})::DOUBLE AS value FROM {source}),
spans AS (SELECT {by}, CASE WHEN low = high THEN low - 0.5 ELSE low END AS low,
                 CASE WHEN low = high THEN high + 0.5 ELSE high END AS high
          FROM (SELECT {by}, min(value) AS low, max(value) AS high FROM entries GROUP BY {by}))
SELECT""",
        1,
    )


def _top_words(k: int) -> str:
    return f"""SELECT label, word, count(*) AS cnt,
        row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, word)::INTEGER AS rank
        FROM (SELECT label, unnest(regexp_extract_all(lower(combined_text),
                     '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS word FROM reviews)
        WHERE NOT list_contains({_STOP}, word)
        GROUP BY label, word
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, word) <= {k}"""


_METRIC_NAMES = ("accuracy", "precision", "recall", "f1", "auc")
_ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in _METRIC_NAMES)
_BUCKETED = """SELECT bucket_no::INTEGER AS bucket_no, ['0-100', '100-300', '300-500', '500-1000', '1000+'][bucket_no + 1] AS length_bucket,
    round(avg(hit), 6) AS accuracy, count(*) AS cnt
    FROM (SELECT CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hit,
                 CASE WHEN length(combined_text) < 100 THEN 0 WHEN length(combined_text) < 300 THEN 1
                      WHEN length(combined_text) < 500 THEN 2
                      WHEN length(combined_text) < 1000 THEN 3 ELSE 4 END AS bucket_no
          FROM {source})
    GROUP BY bucket_no"""
_NB_SCORED = "SELECT doc_id, label, prediction, round(prob, 6) AS prob FROM nb_scored"
_DEMO = ", ".join(f"('{term}', {weight!r}::DOUBLE)" for term, weight in DEMO_WEIGHTS.items())


def _errors(label: int, prediction: int, order: str) -> str:
    return _sql(
        f"""SELECT doc_id, round(prob, 6) AS confidence, substr(combined_text, 1, 300) AS preview
            FROM rules WHERE label = {label} AND prediction = {prediction}
            ORDER BY prob {order}, doc_id LIMIT 20""",
        "rules",
    )


ORACLES: dict[str, str] = {
    # Sources and sinks
    "scan_parquet": "SELECT doc_id, source AS title, text FROM documents",
    "scan_csv": _sql("SELECT polarity, title, text FROM raw", "raw"),
    "conform_schema": _sql("SELECT doc_id, polarity, title, text FROM raw", "raw"),
    "sink_roundtrip": _sql("SELECT doc_id, polarity, title, text FROM raw", "raw"),
    "null_drop_counts": """SELECT count(*) AS rows_before,
        count(CASE WHEN doc_id IS NOT NULL AND quality IS NOT NULL AND source IS NOT NULL
                    AND text IS NOT NULL THEN 1 END) AS rows_after
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "preview_rows": _sql("SELECT doc_id, polarity, title, text FROM raw ORDER BY doc_id LIMIT 5", "raw"),
    # Projections and filters
    "prep_reviews": _sql("SELECT doc_id, title, combined_text, label, split FROM reviews", "reviews"),
    "label_map": """SELECT quality + toxic + 1 AS polarity,
        CASE WHEN quality + toxic + 1 = 1 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label,
        count(*) AS cnt FROM labels GROUP BY ALL""",
    "correct_flag": _sql(
        "SELECT doc_id, CASE WHEN label = prediction THEN 1 ELSE 0 END AS is_correct FROM rules", "rules"
    ),
    "text_lengths": _sql("SELECT * FROM lengths", "lengths"),
    "score_input_guard": f"""SELECT conv_id, turn, substr(text, 1, 512) AS model_input
        FROM conversations WHERE len(regexp_extract_all(text, '{_RUN}')) > 0""",
    "verdict": _sql(
        """SELECT doc_id, CASE WHEN prediction = 1 THEN 'Positive' ELSE 'Negative' END AS sentiment,
           round(greatest(prob, 1.0::DOUBLE - prob), 6) AS confidence FROM rules""",
        "rules",
    ),
    # Sampling and splitting
    "sample_fraction": _sql(
        f"SELECT doc_id, title FROM articles WHERE {_rank('42')} < {int(SAMPLE_FRACTION * RANK_SPAN)}",
        "articles",
    ),
    "sample_exact": _sql(
        f"SELECT doc_id, title FROM articles ORDER BY {_rank('42')}, doc_id LIMIT {SAMPLE_ROWS}",
        "articles",
    ),
    "sample_per_class": _sql(
        f"""SELECT doc_id, label FROM reviews QUALIFY row_number() OVER
            (PARTITION BY label ORDER BY {_rank('42')}, doc_id) <= {SAMPLE_PER_CLASS}""",
        "reviews",
    ),
    # Whole conversations go in by rank; only the last one of a role may be cut, wherever its rows stand.
    "sample_per_class_turns": f"""
        SELECT role, least(any_value(total), {SAMPLE_PER_CLASS}) AS cnt, count(*) FILTER (before < {SAMPLE_PER_CLASS}) AS conversations
        FROM (SELECT role, sum(n) OVER (PARTITION BY role)::BIGINT AS total, sum(n) OVER (PARTITION BY role ORDER BY rank) - n AS before
              FROM (SELECT role, ('0x' || substr(md5('42:' || conv_id::VARCHAR), 1, 15))::BIGINT AS rank, count(*) AS n
                    FROM conversations GROUP BY role, conv_id))
        GROUP BY role""",
    "stratified_split": _sql(
        f"""SELECT doc_id, label, CASE WHEN row_number() OVER
                   (PARTITION BY label ORDER BY {_rank('42')}, doc_id)
                   <= round(0.1::DOUBLE * count(*) OVER (PARTITION BY label))
                   THEN 'validation' ELSE 'train' END AS part FROM reviews""",
        "reviews",
    ),
    # Data profile
    "split_counts": _sql("SELECT split, count(*) AS cnt FROM reviews GROUP BY split", "reviews"),
    "class_distribution": _sql(
        "SELECT split, label, count(*) AS cnt FROM reviews GROUP BY split, label", "reviews"
    ),
    "hist_char_length": _binned(
        "(SELECT 'char_length' AS series, least(char_length, 3000) AS v FROM lengths)",
        "series", "v", 100, "lengths",
    ),
    "hist_word_count": _binned(
        "(SELECT 'word_count' AS series, least(word_count, 500) AS v FROM lengths)",
        "series", "v", 100, "lengths",
    ),
    "hist_title_text": _binned(
        """(SELECT 'title' AS series, least(title_len, 200) AS v FROM lengths
            UNION ALL SELECT 'text', least(text_len, 3000) FROM lengths)""",
        "series", "v", 50, "lengths",
    ),
    "length_density": _sql(
        f""", words AS (SELECT label, least(len(regexp_extract_all(combined_text, '{_RUN}')), 500)
                               ::DOUBLE AS v FROM reviews),
            stats AS (SELECT label, count(*) AS n, stddev_samp(v) AS s, min(v) AS low, max(v) AS high
                      FROM words GROUP BY label),
            grid AS (SELECT label, pow(n, -0.2) * s AS h, n, point,
                            low - 0.5 * (high - low) + point * (2.0 * (high - low) / 999.0) AS x
                     FROM (SELECT *, unnest(range(1000)) AS point FROM stats))
            SELECT label, point::INTEGER AS point, round(any_value(x), 6) AS x,
                   round(sum(exp(-0.5 * pow((x - v) / h, 2))
                         / (n * h * sqrt(2.0 * pi()))), 9) AS density
            FROM grid JOIN words USING (label) GROUP BY label, point""",
        "reviews",
    ).replace("\n, words AS", ",\nwords AS", 1),
    "top_words_by_class": _sql(_top_words(30), "reviews"),
    "word_weights": _sql(
        f"""SELECT label, word, cnt, rank,
                   round(cnt / max(cnt) OVER (PARTITION BY label)::DOUBLE, 6) AS weight
            FROM ({_top_words(200)})""",
        "reviews",
    ),
    "length_summary": _sql(
        """SELECT measure, count(*) AS count, round_even(avg(v), 1) AS mean,
                  round_even(stddev_samp(v), 1) AS std, min(v) AS min,
                  round_even(quantile_cont(v, 0.25), 1) AS p25, round_even(quantile_cont(v, 0.5), 1) AS p50,
                  round_even(quantile_cont(v, 0.75), 1) AS p75, max(v) AS max
           FROM (SELECT measure, v::DOUBLE AS v FROM lengths
                 UNPIVOT (v FOR measure IN (char_length, word_count, title_len, text_len)))
           GROUP BY measure""",
        "lengths",
    ),
    # Evaluation
    "metrics": _sql(
        f"SELECT {_ROUNDED} FROM rule_runs WHERE seq = 0", "rule_runs"
    ),
    "metrics_partly_scored": _sql(
        f"SELECT {_ROUNDED} FROM partly_metrics CROSS JOIN partly_auc", "partly_metrics", "partly_auc"
    ),
    "roc_partly_scored": _sql(
        """SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
           UNION ALL SELECT CASE WHEN isfinite(score) THEN round(score, 6) ELSE score END,
                            round(neg_upto / negatives, 6), round(pos_upto / positives, 6)
           FROM partly_ranked""",
        "partly_ranked",
    ),
    "auc_exact": _sql("SELECT round(auc, 6) AS auc FROM rule_auc WHERE seq = 0", "rule_auc"),
    "confusion_matrix": _sql(
        """SELECT l.label, p.prediction, count(r.doc_id) AS cnt
           FROM (SELECT unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS label) l
           CROSS JOIN (SELECT unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS prediction) p
           LEFT JOIN rules r ON r.label = l.label AND r.prediction = p.prediction
           GROUP BY l.label, p.prediction""",
        "rules",
    ),
    "roc_points": _sql(
        """SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
           UNION ALL SELECT round(score, 6), round(neg_upto / negatives, 6),
                            round(pos_upto / positives, 6) FROM ranked""",
        "ranked",
    ),
    "pr_points": _sql(
        """SELECT NULL::DOUBLE AS threshold, 1.0::DOUBLE AS precision, 0.0::DOUBLE AS recall
           UNION ALL SELECT round(score, 6), round(pos_upto / (pos_upto + neg_upto), 6),
                            round(pos_upto / positives, 6) FROM ranked""",
        "ranked",
    ),
    "average_precision": _sql(
        """SELECT round(sum((recall - before) * precision), 6) AS average_precision
           FROM (SELECT recall, precision,
                        coalesce(lag(recall) OVER (ORDER BY score DESC), 0.0) AS before
                 FROM (SELECT score, pos_upto / positives AS recall,
                              pos_upto / (pos_upto + neg_upto) AS precision FROM ranked))""",
        "ranked",
    ),
    "error_overview": _sql(
        """SELECT total, correct, total - correct AS incorrect,
                  round(100.0::DOUBLE * correct / total, 6) AS correct_pct,
                  round(100.0::DOUBLE * (total - correct) / total, 6) AS incorrect_pct
           FROM (SELECT count(*) AS total,
                        sum(CASE WHEN label = prediction THEN 1 ELSE 0 END)::BIGINT AS correct
                 FROM rules)""",
        "rules",
    ),
    "accuracy_by_length": _sql(_BUCKETED.format(source="rules"), "rules"),
    "confidence_hist": _binned(
        "(SELECT CASE WHEN label = prediction THEN 1 ELSE 0 END AS is_correct, prob FROM rules)",
        "is_correct", "prob", 50, "rules",
    ),
    "top_false_positives": _errors(0, 1, "DESC"),
    "top_false_negatives": _errors(1, 0, "ASC"),
    "confusion_gaps": _sql(
        """SELECT l.label, p.prediction, count(r.doc_id) AS cnt
           FROM (SELECT unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS label) l
           CROSS JOIN (SELECT unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS prediction) p
           LEFT JOIN gaps r ON r.label = l.label AND r.prediction = p.prediction
           GROUP BY l.label, p.prediction""",
        "gaps",
    ),
    "metrics_gaps": _sql(
        f"""SELECT measure, round(value, 6) AS value
            FROM (SELECT {", ".join(_METRIC_NAMES[:-1])}, total::DOUBLE AS total, correct::DOUBLE AS correct, (total - correct)::DOUBLE AS incorrect,
                         100.0::DOUBLE * correct / total AS correct_pct, 100.0::DOUBLE * (total - correct) / total AS incorrect_pct
                  FROM ({_weighted("gap_cells")})
                  CROSS JOIN (SELECT count(*) AS total, count(*) FILTER (label = given) AS correct FROM gaps))
            UNPIVOT (value FOR measure IN (accuracy, precision, recall, f1, total, correct, incorrect, correct_pct, incorrect_pct))""",
        "gap_cells",
    ),
    "confidence_hist_gaps": _binned(
        "(SELECT CASE WHEN label = prediction THEN 1 ELSE 0 END AS is_correct, prob FROM gaps WHERE isfinite(prob))",
        "is_correct", "prob", 50, "gaps",
    ) + """
UNION ALL SELECT CASE WHEN label = prediction THEN 1 ELSE 0 END, -1, NULL, count(*) FROM gaps
WHERE prob IS NULL OR NOT isfinite(prob) GROUP BY 1""",
    "top_errors_gaps": _sql(
        " UNION ALL ".join(
            f"""(SELECT doc_id, CASE WHEN isfinite(prob) THEN round(prob, 6) ELSE prob END AS confidence,
                        substr(combined_text, 1, 300) AS preview, '{kind}' AS kind
                 FROM gaps WHERE label = {label} AND given = {1 - label}
                 ORDER BY CASE WHEN isfinite(prob) THEN prob END {order} NULLS LAST, doc_id LIMIT 20)"""
            for kind, label, order in (("fp", 0, "DESC"), ("fn", 1, "ASC"))
        ),
        "gaps",
    ),
    # Features
    "tokens": _sql(
        """SELECT doc_id, len(tokens)::INTEGER AS n_tokens, array_to_string(tokens, '|') AS tokens
           FROM article_tokens""",
        "article_tokens",
    ),
    "tokens_filtered": _sql(
        """SELECT doc_id, len(kept)::INTEGER AS n_tokens, array_to_string(kept, '|') AS tokens
           FROM article_kept""",
        "article_kept",
    ),
    "bigrams": _sql(
        "SELECT doc_id, array_to_string(grams, '|') AS bigrams FROM article_bigrams", "article_bigrams"
    ),
    "vocabulary": _sql(
        "SELECT idx::INTEGER AS idx, term, cnt, df FROM article_vocabulary", "article_vocabulary"
    ),
    "bigram_vocabulary": _sql(
        "SELECT idx::INTEGER AS idx, term, cnt, df FROM bigram_vocabulary", "bigram_vocabulary"
    ),
    "term_counts": _sql(
        """SELECT doc_id, idx::INTEGER AS idx, term, count(*) AS cnt
           FROM article_terms JOIN (SELECT idx, term FROM article_vocabulary) USING (term)
           GROUP BY doc_id, idx, term""",
        "article_vocabulary",
    ),
    "tfidf_terms": _sql(
        """SELECT doc_id, idx::INTEGER AS idx, term, tf, df,
                  round(tf * ln((n + 1.0::DOUBLE) / (df + 1.0::DOUBLE)), 6) AS tfidf
           FROM (SELECT doc_id, idx, term, df, count(*) AS tf
                 FROM article_terms JOIN article_vocabulary USING (term)
                 GROUP BY doc_id, idx, term, df)
           CROSS JOIN (SELECT count(*) AS n FROM articles)""",
        "article_vocabulary",
    ),
    "hashed_tf": _sql(
        "SELECT count(*) AS n_docs, sum(len(kept))::BIGINT AS total_tf FROM article_kept", "article_kept"
    ),
    "features_count_vectorizer": _sql(
        """SELECT idx::INTEGER AS slot, round(cnt / n::DOUBLE, 6) AS mean, df AS docs
           FROM article_vocabulary CROSS JOIN (SELECT count(*) AS n FROM articles)""",
        "article_vocabulary",
    ),
    "features_ngram_cv": _sql(
        """SELECT idx::INTEGER AS slot, round(cnt / n::DOUBLE, 6) AS mean, df AS docs
           FROM bigram_vocabulary CROSS JOIN (SELECT count(*) AS n FROM articles)""",
        "bigram_vocabulary", "articles",
    ),
    # Models: naive Bayes has a closed form
    "train_nb": _sql(
        f""", test AS (SELECT * FROM nb_scored WHERE split = 'test'),
            cells AS (SELECT
                sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
                sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS fp,
                sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn,
                sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS fn FROM test),
            area AS (SELECT sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc
                FROM (SELECT *, sum(neg) OVER (ORDER BY prob) - neg AS below
                      FROM (SELECT prob, sum(label) AS pos, sum(1 - label) AS neg
                            FROM test GROUP BY prob)))
            SELECT {_ROUNDED} FROM ({_weighted("cells")}) CROSS JOIN area""",
        "nb_scored",
    ).replace("\n, test AS", ",\ntest AS", 1),
    "grid_nb": _sql(
        f"""SELECT seq::INTEGER AS seq, 'naive_bayes' AS model, ['count_vectorizer', 'ngram_cv'][seq + 1] AS feature_type, {_ROUNDED},
                   row_number() OVER (ORDER BY accuracy DESC, seq) = 1 AS is_best FROM grid_runs""",
        "grid_runs",
    ),
    "scaling_nb": _sql(
        f"""SELECT ({[float(f) for f in FRACTIONS]}::DOUBLE[])[seq + 1] AS fraction,
                   count(*) FILTER (part = 'train') AS n_rows, round(any_value(accuracy), 6) AS accuracy
            FROM scaling_docs LEFT JOIN (SELECT seq, avg(CASE WHEN prediction = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy
                                         FROM scaling_rows GROUP BY seq) USING (seq)
            GROUP BY seq""",
        "scaling_docs", "scaling_rows",
    ),
    "score_batch": _sql(_NB_SCORED, "nb_scored"),
    "model_roundtrip": _sql(_NB_SCORED, "nb_scored"),
    "nb_predict": _sql(_NB_SCORED, "nb_scored"),
    "nb_accuracy_by_length": _sql(_BUCKETED.format(source="nb_scored"), "nb_scored"),
    "nb_weights": _sql(
        """SELECT label, idx::INTEGER AS idx, term, tf, round(theta, 6) AS theta, round(pi, 6) AS pi
           FROM nb_model""",
        "nb_model",
    ),
    "score_with_weights": _sql(
        f"""SELECT doc_id, round(margin, 6) AS margin, round(1.0 / (1.0 + exp(-margin)), 6) AS prob,
                   CASE WHEN margin > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
            FROM (SELECT a.doc_id, coalesce(e.evidence, 0.0) + {DEMO_INTERCEPT!r}::DOUBLE AS margin
                  FROM articles a
                  LEFT JOIN (SELECT doc_id, sum(weight) AS evidence
                             FROM article_terms JOIN (VALUES {_DEMO}) w(term, weight) USING (term)
                             GROUP BY doc_id) e USING (doc_id))""",
        "article_terms",
    ),
    # Run tables
    "best_run": _sql(
        """SELECT seq, model, feature_type, round(accuracy, 6) AS accuracy
           FROM rule_metrics ORDER BY accuracy DESC, seq LIMIT 1""",
        "rule_metrics",
    ),
    "run_comparison": _sql(
        "SELECT model, feature_type, "
        + ", ".join(f"format('{{:.4f}}', round({m}, 9)) AS {m}" for m in _METRIC_NAMES)
        + ", '0.0s' AS training_time FROM rule_runs",
        "rule_runs",
    ),
    "run_comparison_long": _sql(
        """SELECT model || ' + ' || feature_type AS run, metric, round(value, 6) AS value
           FROM rule_runs UNPIVOT (value FOR metric IN (accuracy, f1))""",
        "rule_runs",
    ),
    "run_pivot": _sql(
        """SELECT metric,
                  round(max(CASE WHEN seq = 0 THEN value END), 6) AS "long_text + characters",
                  round(max(CASE WHEN seq = 1 THEN value END), 6) AS "long_text + words",
                  round(max(CASE WHEN seq = 2 THEN value END), 6) AS "short_text + characters"
           FROM rule_runs UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1, auc))
           GROUP BY metric""",
        "rule_runs",
    ),
    "runs_json": _sql(f"SELECT seq, model, feature_type, {_ROUNDED} FROM rule_runs", "rule_runs"),
    "run_log": _sql(
        """SELECT model || '_' || feature_type AS run_name, model AS model_name,
                  '3000' AS max_chars, metric, round(value, 6) AS value
           FROM (SELECT *, 0.0::DOUBLE AS training_time_seconds FROM rule_runs)
           UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1, auc, training_time_seconds))""",
        "rule_runs",
    ),
    # Streaming
    "stream_counts": f"""
        SELECT measure, value FROM (
            SELECT count(*) AS n_read, count(*) FILTER (ok) AS n_scored, count(*) FILTER (NOT ok) AS n_rejected,
                   count(*) FILTER (ok) AS rows_verdicts, count(*) FILTER (NOT ok) AS rows_rejected
            FROM (SELECT doc_id % 7 > 1 AND coalesce(len(regexp_extract_all(text, '{_RUN}')) > 0, false) AS ok FROM documents))
        UNPIVOT (value FOR measure IN (n_read, n_scored, n_rejected, rows_verdicts, rows_rejected))""",
    "score_stream": _sql(
        """SELECT doc_id, CASE WHEN margin > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
                  round(prob, 6) AS prob,
                  CASE WHEN margin > 0 THEN 'Positive' ELSE 'Negative' END AS sentiment,
                  round(greatest(prob, 1.0::DOUBLE - prob), 6) AS confidence
           FROM stream_scored""",
        "stream_scored",
    ),
}
