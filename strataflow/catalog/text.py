"""Text analytics, similarity and search (N)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import search, similarity, texts
from ..plans import curated
from .registry import VIEWS, query
from .scratch import scratch

TOKENS = r"list_filter(string_split_regex(lower({c}), '[^\p{{L}}]+'), lambda w: w <> '')"
SENTENCES = r"list_filter(list_transform(string_split_regex({c}, '[.!?\n]+'), lambda s: trim(s)), lambda s: s <> '')"


def _words(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _hits(tokens, values):
    return f"len(list_filter({tokens}, lambda w: w IN {_words(values)}))"


VIEWS.update(
    {
        "turn_tokens": f"SELECT conv_id, turn, role, text, {TOKENS.format(c='text')} AS toks FROM conversations",
        "doc_tokens": f"SELECT doc_id, lang, source, text, {TOKENS.format(c='text')} AS toks FROM documents",
        "doc_sentences": f"""SELECT doc_id, lang, pos - 1 AS pos, sentence FROM (
            SELECT doc_id, lang, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos
            FROM (SELECT doc_id, lang, {SENTENCES.format(c='text')} AS s FROM documents))""",
        "term_weight": """SELECT term, COUNT(*) AS n_docs,
            CAST(ROUND(LN((SELECT CAST(COUNT(*) AS DOUBLE) FROM documents) / COUNT(*)) * 1000000) AS BIGINT) AS weight
            FROM (SELECT doc_id, unnest(list_distinct(toks)) AS term FROM doc_tokens) GROUP BY term""",
        "sent_scores": f"""SELECT doc_id, lang, pos, sentence, CAST(SUM(weight) AS DOUBLE) / MAX(n_words) AS score
            FROM (SELECT doc_id, lang, pos, sentence, len(toks) AS n_words, unnest(toks) AS term
                  FROM (SELECT *, {TOKENS.format(c='sentence')} AS toks FROM doc_sentences)) x
            JOIN term_weight w ON x.term = w.term GROUP BY doc_id, lang, pos, sentence""",
    }
)

POS_SQL, NEG_SQL = _hits("toks", tx.POSITIVE), _hits("toks", tx.NEGATIVE)
SCORE_SQL = f"CASE WHEN {POS_SQL} + {NEG_SQL} > 0 THEN CAST({POS_SQL} - {NEG_SQL} AS DOUBLE) / ({POS_SQL} + {NEG_SQL}) ELSE 0.0 END"
LABEL_SQL = "CASE WHEN score < -0.3 THEN 'NEGATIVE' WHEN score > 0.3 THEN 'POSITIVE' ELSE 'NEUTRAL' END"

# Topics that occur in the given texts: function words of four languages.
TOPICS = {
    "English": ("the", "and", "that", "with"),
    "German": ("der", "die", "und", "von"),
    "French": ("le", "la", "les", "des"),
    "Spanish": ("el", "los", "de", "en"),
}


@query(
    "n01_sentiment",
    f"""SELECT doc_id, score AS sentiment_score, {LABEL_SQL} AS sentiment_label, left(text, 150) || '...' AS preview
        FROM (SELECT *, {SCORE_SQL} AS score FROM doc_tokens)""",
)
def n01(t):
    from ..functions.scoring import sentiment_label

    d = t.raw("documents").withColumn("sentiment_score", tx.sentiment(tx.tokens("text")))
    return d.select(
        "doc_id", "sentiment_score", sentiment_label("sentiment_score").alias("sentiment_label"),
        F.concat(F.left("text", F.lit(150)), F.lit("...")).alias("preview"),
    )


@query(
    "n02_extractive_summary",
    """SELECT doc_id, string_agg(sentence, '. ' ORDER BY pos) AS summary, COUNT(*) AS n_sentences FROM (
         SELECT * FROM sent_scores QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) <= 3)
       GROUP BY doc_id""",
)
def n02(t):
    return texts.summarize(t.raw("documents"), ["doc_id"], "text")


QUESTION = ("worthless", "that", "with")


@query(
    "n03_answer_extraction",
    f"""WITH dfs AS (SELECT term, weight FROM term_weight WHERE term IN {_words(QUESTION)})
        SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence, CAST(score AS BIGINT) AS score FROM (
          SELECT s.doc_id, s.pos, s.sentence, SUM(d.weight) AS score
          FROM (SELECT doc_id, pos, sentence, unnest(list_distinct({TOKENS.format(c='sentence')})) AS term FROM doc_sentences) s
          JOIN dfs d ON s.term = d.term GROUP BY s.doc_id, s.pos, s.sentence HAVING SUM(d.weight) > 0)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) = 1""",
)
def n03(t):
    return texts.answer_question(t.raw("documents").select("doc_id", "text"), ["doc_id"], "text", QUESTION).select(
        "doc_id", "pos", "sentence", "score"
    )


def _topic_sql(source, topics=TOPICS):
    counts = ", ".join(f"{_hits('toks', w)} AS h{i}" for i, w in enumerate(topics.values()))
    names = list(topics)
    total = " + ".join(f"h{i}" for i in range(len(names)))
    top = f"GREATEST({', '.join(f'h{i}' for i in range(len(names)))})"
    label = " ".join(f"WHEN h{i} = {top} THEN '{n}'" for i, n in enumerate(names))
    return f"""SELECT *, CASE WHEN {total} = 0 THEN 'General Inquiry' {label} END AS category,
        CASE WHEN {total} = 0 THEN 0.0 ELSE CAST({top} AS DOUBLE) / ({total}) END AS confidence
        FROM (SELECT *, {counts} FROM {source})"""


@query("n04_classification", f"SELECT conv_id, turn, category, confidence FROM ({_topic_sql('turn_tokens')})")
def n04(t):
    c = t.raw("conversations").withColumn("_c", tx.classify(tx.tokens("text"), TOPICS))
    return c.select("conv_id", "turn", F.col("_c.label").alias("category"), F.col("_c.confidence").alias("confidence"))


RULE = ("trash", "scum", "idiot", "worthless")


@query(
    "n05_text_filter",
    f"SELECT doc_id, lang FROM doc_tokens WHERE {_hits('toks', RULE)} > 0",
)
def n05(t):
    return t.raw("documents").where(tx.has_any(tx.tokens("text"), RULE)).select("doc_id", "lang")


def _topics_of(df):
    words = tx.tokens("text")
    flags = [F.when(tx.has_any(words, w), F.lit(n)) for n, w in TOPICS.items()]
    return df.withColumn("topics", F.array_compact(F.array(*flags)))


_TOPIC_ROWS = " UNION ALL ".join(
    "SELECT {key}, '%s' AS topic FROM {source} WHERE %s > 0" % (n, _hits("toks", w)) for n, w in TOPICS.items()
)


@query(
    "j11_text_relation_join",
    f"""WITH l AS ({_TOPIC_ROWS.format(key='conv_id, turn', source='turn_tokens')}),
             r AS ({_TOPIC_ROWS.format(key='doc_id', source='doc_tokens')}),
        lc AS (SELECT topic, COUNT(*) AS n_left FROM l GROUP BY topic), rc AS (SELECT topic, COUNT(*) AS n_right FROM r GROUP BY topic),
        lf AS (SELECT topic, string_agg(conv_id || ':' || turn, ',' ORDER BY conv_id, turn) AS first_left FROM (
               SELECT * FROM l QUALIFY ROW_NUMBER() OVER (PARTITION BY topic ORDER BY conv_id, turn) <= 3) GROUP BY topic),
        rf AS (SELECT topic, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS first_right FROM (
               SELECT * FROM r QUALIFY ROW_NUMBER() OVER (PARTITION BY topic ORDER BY doc_id) <= 3) GROUP BY topic)
        SELECT topic, n_left, n_right, n_left * n_right AS n_pairs, first_left, first_right
        FROM lc JOIN rc USING (topic) JOIN lf USING (topic) JOIN rf USING (topic)""",
)
def j11(t):
    return texts.topic_relations(
        _topics_of(t.raw("conversations")), _topics_of(t.raw("documents")), ["conv_id", "turn"], ["doc_id"]
    )


def _all(kind):
    return f"regexp_extract_all(text, '{tx.PATTERNS[kind]}')"


@query(
    "n06_field_extraction",
    f"""SELECT doc_id, {_all('EMAIL')}[1] AS first_email, CAST(len({_all('EMAIL')}) AS INTEGER) AS n_emails,
               {_all('PHONE_NUMBER')}[1] AS first_phone, {_all('IP_ADDRESS')}[1] AS first_ip,
               CAST(len({_all('CARD_NUMBER')}) AS INTEGER) AS n_card_numbers, {_all('AMOUNT')}[1] AS first_amount FROM documents""",
)
def n06(t):
    d = t.raw("documents").withColumn(
        "f", tx.extract_fields("text", ["EMAIL", "PHONE_NUMBER", "IP_ADDRESS", "CARD_NUMBER", "AMOUNT"])
    )
    return d.select(
        "doc_id",
        F.get("f.email", F.lit(0)).alias("first_email"), F.size("f.email").alias("n_emails"),
        F.get("f.phone_number", F.lit(0)).alias("first_phone"), F.get("f.ip_address", F.lit(0)).alias("first_ip"),
        F.size("f.card_number").alias("n_card_numbers"), F.get("f.amount", F.lit(0)).alias("first_amount"),
    )


def _replace(inner, kind):
    return f"regexp_replace({inner}, '{tx.PATTERNS[kind]}', '[{kind}]', 'g')"


_LUHN = """list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 1 THEN
    CASE WHEN CAST(substr(c, i, 1) AS INTEGER) * 2 > 9 THEN CAST(substr(c, i, 1) AS INTEGER) * 2 - 9
         ELSE CAST(substr(c, i, 1) AS INTEGER) * 2 END ELSE CAST(substr(c, i, 1) AS INTEGER) END)) % 10 = 0"""
VIEWS["redacted"] = f"""SELECT doc_id, lang, replace(replace(replace({_replace(_replace(_replace('t2', 'PHONE_NUMBER'), 'IP_ADDRESS'), 'DATE')},
    'James Smith', '[NAME]'), 'Maria Garcia', '[NAME]'), 'Wei Chen', '[NAME]') AS safe_text FROM (
    SELECT doc_id, lang, list_reduce(list_prepend(t1, list_filter(list_distinct(regexp_extract_all(t1, '{tx.PATTERNS['CARD_NUMBER']}')),
           lambda c: {_LUHN})), lambda acc, c: replace(acc, c, '[CARD_NUMBER]')) AS t2
    FROM (SELECT doc_id, lang, {_replace('text', 'EMAIL')} AS t1 FROM documents))"""


@query("n07_redaction", "SELECT doc_id, md5(safe_text) AS safe_md5, CAST(length(safe_text) AS INTEGER) AS safe_length FROM redacted")
def n07(t):
    d = t.raw("documents").select("doc_id", tx.redact("text").alias("safe_text"))
    return d.select("doc_id", F.md5("safe_text").alias("safe_md5"), F.length("safe_text").alias("safe_length"))


@query(
    "n07_redaction_chosen_categories",
    f"SELECT doc_id, md5({_replace('text', 'PHONE_NUMBER')}) AS safe_md5 FROM documents",
)
def n07b(t):
    return t.raw("documents").select("doc_id", F.md5(tx.redact("text", ["PHONE_NUMBER"])).alias("safe_md5"))


@query(
    "n07_redact_then_score",
    f"""SELECT doc_id, {SCORE_SQL} AS sentiment_score FROM (SELECT doc_id, {TOKENS.format(c='safe_text')} AS toks FROM redacted)""",
)
def n07c(t):
    d = t.raw("documents").select("doc_id", tx.redact("text").alias("safe_text"))
    return d.select("doc_id", tx.sentiment(tx.tokens("safe_text")).alias("sentiment_score"))


@query(
    "n08_hashed_embedding",
    """SELECT doc_id, 64 AS dims, CAST(COUNT(DISTINCT CAST('0x' || substr(md5(term), 1, 6) AS INTEGER) % 64) AS INTEGER) AS filled,
              CAST(1.0 AS DOUBLE) AS length FROM (SELECT doc_id, unnest(toks) AS term FROM doc_tokens) GROUP BY doc_id""",
)
def n08(t):
    from ..functions.vectors import norm

    v = texts.hashed_vectors(t.raw("documents"), ["doc_id"], "text")
    return v.select(
        "doc_id", F.size("embedding").alias("dims"), F.size(F.filter("embedding", lambda x: x > 0)).alias("filled"),
        F.round(norm("embedding"), 6).alias("length"),
    )


@query(
    "n09_themes_by_group",
    """WITH counts AS (SELECT lang, term, COUNT(*) AS n_docs FROM (SELECT lang, unnest(list_distinct(toks)) AS term FROM doc_tokens)
                       WHERE length(term) >= 4 GROUP BY lang, term),
       scored AS (SELECT c.lang, c.term, c.n_docs, c.n_docs * w.weight AS score FROM counts c JOIN term_weight w ON c.term = w.term)
       SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, term) AS INTEGER) AS theme_rank FROM scored
       QUALIFY theme_rank <= 5""",
)
def n09(t):
    return texts.themes(t.raw("documents"), ["doc_id"], "text", "lang")


@query(
    "n10_group_summary",
    """SELECT lang, n_docs, summary FROM (SELECT lang, COUNT(*) AS n_docs FROM documents GROUP BY lang) JOIN (
         SELECT lang, string_agg(sentence, ' | ' ORDER BY r) AS summary FROM (
           SELECT lang, sentence, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, doc_id, pos) AS r FROM sent_scores)
         WHERE r <= 3 GROUP BY lang) USING (lang)""",
)
def n10(t):
    return texts.summarize_groups(t.raw("documents"), ["doc_id"], "text", "lang")


ENTITIES = ("that", "with", "der", "les", "los")


@query(
    "n11_entity_sentiment",
    f"""WITH hits AS (SELECT unnest(list_filter(list_distinct(toks), lambda w: w IN {_words(ENTITIES)})) AS entity,
              {POS_SQL} AS p, {NEG_SQL} AS n FROM (SELECT {TOKENS.format(c='sentence')} AS toks FROM doc_sentences))
        SELECT entity, COUNT(*) AS mentions, CAST(SUM(p) AS BIGINT) AS positive, CAST(SUM(n) AS BIGINT) AS negative,
               CASE WHEN SUM(p) + SUM(n) > 0 THEN CAST(SUM(p) - SUM(n) AS DOUBLE) / CAST(SUM(p) + SUM(n) AS DOUBLE) ELSE 0.0 END AS sentiment
        FROM hits GROUP BY entity""",
)
def n11(t):
    return texts.entity_sentiment(t.raw("documents").select("text"), "text", ENTITIES)


#: Subject and team of each ticket, as the analyzer reads them.
TICKET_TOKENS = f"""(SELECT *, {TOKENS.format(c="(subject || ': ' || assigned_to)")} AS toks FROM tickets)"""


@query(
    "n12_ticket_analyzer",
    f"""SELECT category, sentiment_label, priority, COUNT(*) AS n, ROUND(AVG(confidence), 6) AS avg_confidence FROM (
          SELECT category, confidence, priority, {LABEL_SQL} AS sentiment_label FROM (
            SELECT *, {SCORE_SQL} AS score FROM ({_topic_sql(TICKET_TOKENS, tx.TICKET_TOPICS)})))
        GROUP BY category, sentiment_label, priority""",
)
def n12(t):
    from ..functions.scoring import sentiment_label

    words = tx.tokens(F.concat("subject", F.lit(": "), "assigned_to"))
    analyzed = (
        t.tickets()
        .select("ticket_id", "priority", tx.sentiment(words).alias("sentiment_score"), tx.classify(words, tx.TICKET_TOPICS).alias("_c"))
        .select(
            "ticket_id", "priority", "sentiment_score", sentiment_label("sentiment_score").alias("sentiment_label"),
            F.col("_c.label").alias("category"), F.col("_c.confidence").alias("confidence"),
        )
    )
    path = scratch(t.spark, "analysis")
    analyzed.write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path).groupBy("category", "sentiment_label", "priority").agg(
        F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("avg_confidence")
    )


@query(
    "n12_topic_languages",
    f"""SELECT category, sentiment_label, COUNT(*) AS n, ROUND(AVG(confidence), 6) AS avg_confidence FROM (
          SELECT category, confidence, {LABEL_SQL} AS sentiment_label FROM (
            SELECT *, {SCORE_SQL} AS score FROM ({_topic_sql('doc_tokens')}))) GROUP BY category, sentiment_label""",
)
def n12_languages(t):
    from ..functions.scoring import sentiment_label

    words = tx.tokens("text")
    analyzed = t.raw("documents").select(tx.sentiment(words).alias("score"), tx.classify(words, TOPICS).alias("_c"))
    return analyzed.groupBy(F.col("_c.label").alias("category"), sentiment_label("score").alias("sentiment_label")).agg(
        F.count("*").alias("n"), F.round(F.avg("_c.confidence"), 6).alias("avg_confidence")
    )


@query(
    "n13_risk_narrative",
    """SELECT c.customer_id, r.assessment_id, 'Customer ' || c.customer_name || ' from ' || c.country || ' with credit score '
              || CAST(c.credit_score AS VARCHAR) || ' has risk score ' || CAST(r.risk_score AS VARCHAR) || '/100 and '
              || r.credit_history || ' credit history.' AS narrative
       FROM customers c JOIN risk_assessments r ON c.customer_id = r.customer_id WHERE r.risk_score > 75
       ORDER BY r.risk_score DESC, r.assessment_id LIMIT 50""",
)
def n13(t):
    r = curated.risk_parsed(t.risk_assessments()).where(F.col("risk_score") > 75)
    x = t.customers().join(r, "customer_id").orderBy(F.desc("risk_score"), "assessment_id").limit(50)
    return x.select(
        "customer_id", "assessment_id",
        F.format_string(
            "Customer %s from %s with credit score %d has risk score %d/100 and %s credit history.",
            "customer_name", "country", "credit_score", "risk_score", "credit_history",
        ).alias("narrative"),
    )


COSINE = "list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


@query(
    "n14_similar_pairs",
    f"""SELECT a.vec_id AS id_a, b.vec_id AS id_b, ROUND({COSINE.format(a='a.embedding', b='b.embedding')}, 6) AS similarity
        FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id ORDER BY similarity DESC, id_a, id_b LIMIT 10""",
)
def n14(t):
    return similarity.top_similar_pairs(t.raw("embeddings"), "vec_id", "embedding", 10)


@query(
    "n15_rank_by_vector",
    f"""SELECT vec_id, label, ROUND({COSINE.format(a='embedding', b='(SELECT embedding FROM embeddings WHERE vec_id = 7)')}, 6) AS similarity
        FROM embeddings ORDER BY similarity DESC, vec_id LIMIT 10""",
)
def n15(t):
    e = t.raw("embeddings")
    query_vector = e.where(F.col("vec_id") == 7).select("embedding").first()[0]
    return similarity.rank_by_vector(e, "embedding", query_vector, 10, "vec_id").select("vec_id", "label", "similarity")


BEST_SQL = f"""WITH cells AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    means AS (SELECT label, i, AVG(CAST(x AS DOUBLE)) AS m FROM cells GROUP BY label, i),
    cents AS (SELECT label AS cent, list(m ORDER BY i) AS v FROM means GROUP BY label)
    SELECT vec_id, CAST(cent AS BIGINT) AS best_label, similarity FROM (
      SELECT vec_id, cent, ROUND({COSINE.format(a='embedding', b='v')}, 6) AS similarity FROM embeddings CROSS JOIN cents)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY similarity DESC, cent) = 1"""


def _best_labels(t):
    e = t.raw("embeddings")
    cents = similarity.centroids(e, "label", "embedding")
    return similarity.best_match(e, "vec_id", "embedding", cents, "label", "centroid").select(
        F.col("id").alias("vec_id"), F.col("match").alias("best_label"), "similarity"
    )


@query("n16_best_match", BEST_SQL)
def n16(t):
    return _best_labels(t)


@query(
    "n16_nearest_neighbour",
    f"""SELECT id, match, similarity FROM (SELECT a.vec_id AS id, b.vec_id AS match, ROUND({COSINE.format(a='a.embedding', b='b.embedding')}, 6) AS similarity
        FROM embeddings a JOIN embeddings b ON a.vec_id % 4 <> 0 AND b.vec_id % 4 = 0)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY id ORDER BY similarity DESC, match) = 1""",
)
def n16_neighbour(t):
    """Every fourth vector is a place to match the others with; both sides are laid in tiles."""
    e = t.raw("embeddings").select("vec_id", "embedding")
    fourth = F.col("vec_id") % 4 == 0
    return similarity.best_match(e.where(~fourth), "vec_id", "embedding", e.where(fourth), "vec_id", "embedding", tile_rows=64)


@query(
    "j09_best_match_join",
    f"""WITH best AS ({BEST_SQL}) SELECT e.label, b.best_label, COUNT(*) AS n FROM best b JOIN embeddings e ON b.vec_id = e.vec_id
        GROUP BY e.label, b.best_label""",
)
def j09(t):
    return _best_labels(t).join(t.raw("embeddings").select("vec_id", "label"), "vec_id").groupBy("label", "best_label").agg(
        F.count("*").alias("n")
    )


@query(
    "j08_ordered_self_join",
    f"""SELECT a.label AS label_a, b.label AS label_b, a.vec_id AS id_a, b.vec_id AS id_b,
               ROUND({COSINE.format(a='a.embedding', b='b.embedding')}, 6) AS similarity
        FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id ORDER BY similarity DESC, id_a, id_b LIMIT 20""",
)
def j08(t):
    e = t.raw("embeddings")
    pairs = similarity.top_similar_pairs(e, "vec_id", "embedding", 20)
    labels = e.select("vec_id", "label")
    a = labels.select(F.col("vec_id").alias("id_a"), F.col("label").alias("label_a"))
    b = labels.select(F.col("vec_id").alias("id_b"), F.col("label").alias("label_b"))
    return pairs.join(a, "id_a").join(b, "id_b").select("label_a", "label_b", "id_a", "id_b", "similarity")


TERMS = ("trash", "that", "worthless")
BM25_SQL = f"""WITH post AS (SELECT doc_id, term, COUNT(*) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM doc_tokens)
           WHERE term IN {_words(TERMS)} GROUP BY doc_id, term),
    lens AS (SELECT doc_id, lang, len(toks) AS doc_len FROM doc_tokens),
    dfs AS (SELECT term, COUNT(*) AS df FROM post GROUP BY term),
    corpus AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, AVG(doc_len) AS avg_len FROM lens),
    scored AS (SELECT p.doc_id, l.lang, ROUND(SUM(LN(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
               / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * doc_len / avg_len))), 6) AS score, COUNT(*) AS terms_hit
        FROM post p JOIN dfs ON p.term = dfs.term JOIN lens l ON p.doc_id = l.doc_id CROSS JOIN corpus GROUP BY p.doc_id, l.lang)"""


@query(
    "n17_search",
    f"""{BM25_SQL} SELECT doc_id AS doc, lang, score, terms_hit FROM scored WHERE lang = 'en' ORDER BY score DESC, doc LIMIT 10""",
)
def n17(t):
    return search.search_texts(t.raw("documents"), "doc_id", "text", TERMS, ("lang",), F.col("lang") == "en")


@query(
    "n17_hybrid_search",
    f"""{BM25_SQL}, words AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY score DESC, doc_id) AS r FROM scored ORDER BY r LIMIT 20),
        vecs AS (SELECT vec_id, ROW_NUMBER() OVER (ORDER BY s DESC, vec_id) AS r FROM (SELECT vec_id,
                 ROUND({COSINE.format(a='embedding', b='(SELECT embedding FROM embeddings WHERE vec_id = 7)')}, 6) AS s FROM embeddings)
                 ORDER BY r LIMIT 20)
        SELECT doc, ROUND(SUM(1.0::DOUBLE / (60 + r)), 9) AS score FROM (
          SELECT doc_id AS doc, r FROM words UNION ALL SELECT vec_id, r FROM vecs) GROUP BY doc ORDER BY 2 DESC, 1 LIMIT 10""",
)
def n17b(t):
    d, e = t.raw("documents"), t.raw("embeddings")
    words = search.search_texts(d, "doc_id", "text", TERMS, k=20)
    query_vector = e.where(F.col("vec_id") == 7).select("embedding").first()[0]
    near = similarity.rank_by_vector(e, "embedding", query_vector, 20, "vec_id")
    # Both lists have at most 20 rows: the unpartitioned windows are bounded.
    a = words.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), "doc")))
    b = near.select(F.col("vec_id").alias("doc"), "similarity").withColumn(
        "rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("similarity"), "doc"))
    )
    return search.fuse_rankings([a, b], "doc", 10)


@query(
    "n18_index_refresh",
    f"""{BM25_SQL} SELECT doc_id AS doc, score, terms_hit FROM scored ORDER BY score DESC, doc LIMIT 10""",
)
def n18(t):
    path = scratch(t.spark, "index")
    d = t.raw("documents").select("doc_id", "text")
    for i in range(2):
        search.refresh_index(d.where(F.pmod("doc_id", F.lit(2)) == i), "doc_id", "text", path, i)
    return search.bm25(*search.read_index(t.spark, path), TERMS)
