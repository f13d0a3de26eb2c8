"""Queries over texts and vectors: keyword matching, vocabulary, similarity, answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens import sources as src
from firmlens.operators import agreement as ag
from firmlens.operators import firms as fo
from firmlens.operators import growing as gr
from firmlens.operators import keywords as kw
from firmlens.operators import label_blocks as bl
from firmlens.operators import labelling as lb
from firmlens.operators import subwords as su
from firmlens.operators import text as to
from firmlens.operators import vectors as ve
from firmlens.operators import vocabulary as vo
from firmlens.plans import bindings as b
from firmlens.plans.registry import query, rounded

W = r"[\p{L}\p{N}_]"

# Keyword dictionary and matching.

PHRASES = """SELECT category, lower(trim(k)) AS keyword
    FROM (SELECT category, unnest(string_split(prompt_output, ', ')) AS k FROM brand_phrases)"""


@query("keyword_dictionary", f"SELECT DISTINCT category, keyword FROM ({PHRASES}) WHERE length(keyword) > 4",
       "brand_phrases")
def keyword_dictionary(spark, sf):
    return kw.keyword_dictionary(b.brand_phrases(spark, sf))


@query("keyword_list", f"SELECT DISTINCT keyword FROM ({PHRASES}) WHERE length(keyword) > 3", "brand_phrases")
def keyword_list(spark, sf):
    return kw.keyword_list(b.brand_phrases(spark, sf))


@query("keyword_dictionary_joined", f"""
    SELECT category, string_agg(keyword, ', ' ORDER BY keyword) AS prompt_output
    FROM (SELECT DISTINCT category, keyword FROM ({PHRASES}) WHERE length(keyword) > 4) GROUP BY category""",
       "brand_phrases")
def keyword_dictionary_joined(spark, sf):
    return kw.joined_dictionary(kw.keyword_dictionary(b.brand_phrases(spark, sf)))


# Occurrences by splitting at the phrase: an occurrence counts if neither neighbour is a
# word character. An empty piece inside the text means two occurrences touch.
MATCHED = f""", parts AS (SELECT url, keyword, string_split(lower(text), keyword) AS parts
      FROM page_text CROSS JOIN (SELECT DISTINCT keyword FROM dictionary)),
    matched AS (SELECT url, keyword, n FROM (
      SELECT url, keyword, len(list_filter(range(1, len(parts)), lambda i:
        (CASE WHEN parts[i] = '' THEN i = 1 ELSE NOT regexp_matches(parts[i], '{W}$') END) AND
        (CASE WHEN parts[i + 1] = '' THEN i + 1 = len(parts) ELSE NOT regexp_matches(parts[i + 1], '^{W}') END)
      ))::BIGINT AS n FROM parts) WHERE n > 0)"""


def dictionary(spark):
    return kw.keyword_dictionary(b.keywords_raw(spark))


def matches(spark, sf):
    return kw.match_keywords(src.spread(b.page_text(spark, sf).select("url", "text")), dictionary(spark))


def lists(spark, sf):
    return kw.match_lists(b.page_ids(spark, sf), matches(spark, sf))


@query("keyword_match", MATCHED + " SELECT url, keyword, n FROM matched", "page_text dictionary")
def keyword_match(spark, sf):
    return matches(spark, sf)


@query("keyword_match_lists", MATCHED + """
    SELECT p.url, coalesce(matches, []::VARCHAR[]) AS matches FROM page_text p LEFT JOIN (
      SELECT url, list(keyword ORDER BY keyword) AS matches FROM (SELECT url, keyword, unnest(range(n)) FROM matched)
      GROUP BY url) m ON p.url = m.url""", "page_text dictionary")
def keyword_match_lists(spark, sf):
    return lists(spark, sf)


@query("keyword_hits", MATCHED + " SELECT url, keyword FROM (SELECT url, keyword, unnest(range(n)) FROM matched)",
       "page_text dictionary")
def keyword_hits(spark, sf):
    return kw.hits_from_lists(lists(spark, sf))


@query("keyword_hits_labelled", MATCHED + """, h AS (SELECT url, keyword, unnest(range(n)) FROM matched)
    SELECT p.url, coalesce(h.keyword, 'No keyword') AS keyword, coalesce(category, 'No category') AS category
    FROM page_text p LEFT JOIN h ON p.url = h.url LEFT JOIN dictionary d ON h.keyword = d.keyword""",
       "page_text dictionary")
def keyword_hits_labelled(spark, sf):
    return kw.label_unmatched(lists(spark, sf), dictionary(spark))


@query("hits_by_firm", MATCHED + """
    SELECT p.id, m.url, category, m.keyword, n FROM matched m JOIN dictionary d ON m.keyword = d.keyword
    JOIN page_text p ON m.url = p.url""", "page_text dictionary")
def hits_by_firm(spark, sf):
    found = kw.attach_category(matches(spark, sf), dictionary(spark))
    return kw.attach_firm(found, b.page_ids(spark, sf)).select("id", "url", "category", "keyword", "n")


@query("firm_keywords", MATCHED + """
    SELECT p.id, category, sum(n)::BIGINT AS n_kw, count(DISTINCT m.keyword) AS n_unique
    FROM matched m JOIN dictionary d ON m.keyword = d.keyword JOIN page_text p ON m.url = p.url GROUP BY ALL""",
       "page_text dictionary")
def firm_keywords(spark, sf):
    """From texts to firm x category counts in one plan."""
    found = kw.attach_firm(kw.attach_category(matches(spark, sf), dictionary(spark)), b.page_ids(spark, sf))
    return found.groupBy("id", "category").agg(
        F.sum("n").alias("n_kw"), F.count_distinct("keyword").alias("n_unique"))


# Texts.

JUNK = " AND ".join(f"NOT contains(text, '{p}')" for p in to.JUNK_PARTS)


def clean_sql(text: str) -> str:
    return f"""SELECT url, id, text FROM (
        SELECT *, row_number() OVER (PARTITION BY text ORDER BY url) AS n
        FROM (SELECT url, id, {text} AS text FROM page_text)
        WHERE text <> '' AND NOT starts_with(text, '{to.JUNK_PREFIX}') AND {JUNK}) WHERE n = 1"""


@query("clean_text", clean_sql("text"), "page_text")
def clean_text(spark, sf):
    return to.clean_text(b.page_text(spark, sf).select("url", "id", "text"))


def grouped_sql(pages: str, part_chars: int) -> str:
    """The texts of firms in parts, as ``group_text`` makes them."""
    return f"""SELECT id, part, string_agg(text, chr(10) ORDER BY url) AS text FROM (
        SELECT g.id, url, text,
               CASE WHEN total > {part_chars}
                    THEN ('0x' || substring(md5(url::VARCHAR), 1, 8))::BIGINT % ceil(total / {part_chars})::BIGINT
                    ELSE 0 END AS part
        FROM {pages} g JOIN (SELECT id, sum(length(text) + 1) AS total FROM {pages} GROUP BY id) z ON g.id = z.id) GROUP BY ALL"""


@query("group_text", grouped_sql("page_text", 1_000_000), "page_text")
def group_text(spark, sf):
    return to.group_text(b.page_text(spark, sf))


@query("group_text_parts", grouped_sql("page_text", 20_000), "page_text")
def group_text_parts(spark, sf):
    """Parts small enough that most firms have several."""
    return to.group_text(b.page_text(spark, sf), part_chars=20_000)


LENGTH = 1024


@query("token_encode", f"""
    , w AS (SELECT url, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word
            FROM (SELECT url, regexp_extract_all(lower(text), '{W}+') AS ws FROM page_text)),
    v AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) + 1 AS token
          FROM (SELECT word, count(*) AS n FROM w GROUP BY word)),
    t AS (SELECT url, ((pos - 1) // {LENGTH})::INTEGER AS "window", list(token::INTEGER ORDER BY pos) AS ids
          FROM w JOIN v ON w.word = v.word GROUP BY ALL),
    e AS (SELECT p.url, coalesce("window", 0) AS "window", coalesce(ids, []::INTEGER[]) AS ids
          FROM page_text p LEFT JOIN t ON p.url = t.url)
    SELECT url, "window", list_resize(ids, {LENGTH}, 0) AS input_ids,
           list_resize(list_transform(ids, lambda x: 1), {LENGTH}, 0) AS attention_mask FROM e""", "page_text")
def token_encode(spark, sf):
    pages = src.spread(b.page_text(spark, sf).select("url", "text"))
    return to.token_encode(pages, to.vocabulary(pages), LENGTH)


@query("subword_encode")
def subword_encode(spark, sf):
    import public_tokenizers

    pages = src.spread(b.page_text(spark, sf).select("url", "text"))
    return su.subword_encode(pages, public_tokenizers.path("word_bpe_49k.json"), 512, before=49406, after=49407)


# Vocabulary. The corpora are two whole tables.

STOP = ", ".join(f"'{w}'" for w in b.STOP_WORDS)
LANGUAGES = ["en", "de", "fr", "es"]
WORDS = f""", w AS (SELECT corpus, lang, unnest(list_distinct(regexp_extract_all(lower(text), '{W}{{2,}}'))) AS word
      FROM corpora),
    s AS (SELECT corpus, count(*) AS n FROM corpora WHERE text IS NOT NULL GROUP BY 1),
    idf AS (SELECT c.corpus, word, df, ln((1 + n) / (1 + df)) + 1 AS idf
      FROM (SELECT corpus, word, count(*) AS df FROM w GROUP BY ALL) c JOIN s ON c.corpus = s.corpus
      WHERE df >= 2 AND df <= 0.95 * n AND word NOT IN ({STOP}))"""
FLAGS = ", ".join(f"count(*) FILTER (lang = '{x}') >= 2 AS {x}" for x in LANGUAGES)
FLAGGED = WORDS + f""", l AS (SELECT word, {FLAGS} FROM w WHERE corpus = 'web' GROUP BY word),
    flagged AS MATERIALIZED (SELECT corpus, idf.word, df, idf, en, de, fr, es FROM idf JOIN l ON idf.word = l.word
      WHERE (en OR de OR fr OR es) AND NOT regexp_matches(idf.word, '[0-9]'))"""


def scores(spark, sf):
    return vo.idf_words(src.spread(b.corpora(spark, sf).select("corpus", "text")), corpus="corpus", stop_words=b.STOP_WORDS)


def flagged(spark, sf):
    """Texts are read once: scores and flags add up the same stored counts per language."""
    counts = src.stored(vo.document_frequencies(src.spread(b.corpora(spark, sf).select("corpus", "lang", "text")), by=["corpus", "lang"]), "words")
    per_corpus = counts.groupBy("corpus", "word").agg(F.sum("df").alias("df"))
    scored = vo.idf_scores(per_corpus, b.STOP_WORDS, corpus="corpus")
    return vo.idf_language(scored, vo.word_lists(counts, LANGUAGES), LANGUAGES)


@query("idf_words", WORDS + " SELECT corpus, word, df, round(idf, 6) AS idf FROM idf", "corpora")
def idf_words(spark, sf):
    return rounded(scores(spark, sf))


@query("idf_growing", f"""
    WITH w AS (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '{W}{{2,}}'))) AS word FROM documents),
    s AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL)
    SELECT word, df, round(ln((1 + n) / (1 + df)) + 1, 6) AS idf FROM (SELECT word, count(*) AS df FROM w GROUP BY word), s
    WHERE df >= 2 AND df <= 0.95 * n""")
def idf_growing(spark, sf):
    """Three batches in another order, one of them twice, added up in between."""
    docs = b.table(spark, sf, "documents").select("doc_id", "text")
    store = gr.GrowingFrequencies(spark, src.shared_folder(spark, "frequencies"))
    for batch in (2, 0, 2, 1):
        store.add(batch, docs.filter(F.col("doc_id") % 3 == batch))
        if batch == 0:
            store.compact()
    return rounded(vo.idf_scores(store.frequencies()))


@query("idf_language", FLAGGED + " SELECT corpus, word, df, round(idf, 6) AS idf, en, de, fr, es FROM flagged", "corpora")
def idf_language(spark, sf):
    return rounded(flagged(spark, sf))


@query("idf_contrast", FLAGGED + """
    SELECT word, round(max(idf) FILTER (corpus = 'pat'), 6) AS idf_pat, round(max(idf) FILTER (corpus = 'web'), 6) AS idf_web,
           round(max(idf) FILTER (corpus = 'pat') - max(idf) FILTER (corpus = 'web'), 6) AS difference
    FROM flagged WHERE en GROUP BY word HAVING count(DISTINCT corpus) = 2""", "corpora")
def idf_contrast(spark, sf):
    return rounded(vo.idf_contrast(flagged(spark, sf).filter("en"), "corpus", "pat", "web"))


# Similarity.

# Every vector is a label too: as many labels as rows, whatever the scale.
NEAR = """WITH near AS (SELECT * FROM (
      SELECT a.vec_id, b.vec_id::VARCHAR AS category, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS similarity
      FROM embeddings a CROSS JOIN embeddings b) WHERE similarity >= 0.25)"""


def own_blocks(spark, sf):
    return bl.label_blocks(b.vectors(spark, sf), "vec_id")


@query("similar_labels", NEAR + " SELECT vec_id, category, round(similarity, 6) AS similarity FROM near")
def similar_labels(spark, sf):
    return bl.similar_labels(b.vectors(spark, sf), own_blocks(spark, sf), 0.25, "vec_id", digits=6)


@query("predicted_labels", NEAR + """
    SELECT e.vec_id, coalesce(predicted, ['unknown']) AS predicted FROM embeddings e LEFT JOIN (
      SELECT vec_id, list(category ORDER BY category) AS predicted FROM near GROUP BY vec_id) n USING (vec_id)""")
def predicted_labels(spark, sf):
    return bl.predicted_labels(b.vectors(spark, sf), own_blocks(spark, sf), "vec_id", threshold=0.25)


SIMS = """, sims AS (SELECT vec_id, c.label::VARCHAR AS category,
      list_cosine_similarity(e.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS similarity
    FROM embeddings e CROSS JOIN categories c)"""


def sims(spark, sf):
    labels = ve.read_labels(b.categories(spark, sf))
    return ve.similarity_arrays(b.vectors(spark, sf), labels, "vec_id"), labels


@query("similarity_matrix", SIMS + " SELECT vec_id, category, round(similarity, 6) AS similarity FROM sims", "categories")
def similarity_matrix(spark, sf):
    return rounded(ve.similarity_long(*sims(spark, sf), "vec_id"))


WIDE = ", ".join(
    f"round(max(similarity) FILTER (category = '{i}'), 6) AS sim_{i}" for i in range(10))


@query("similarity_wide", SIMS + f" SELECT vec_id, {WIDE} FROM sims GROUP BY vec_id", "categories")
def similarity_wide(spark, sf):
    return rounded(ve.similarity_wide(*sims(spark, sf), "vec_id"))


@query("similarity_categories", SIMS + """
    SELECT vec_id, coalesce(list(category ORDER BY category) FILTER (similarity >= 0.1), ['unknown']) AS predicted
    FROM sims GROUP BY vec_id""", "categories")
def similarity_categories(spark, sf):
    return ve.predicted(*sims(spark, sf), "vec_id", 0.1)


@query("top_quantile", SIMS + """,
    r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY similarity) AS rn,
                 count(*) OVER (PARTITION BY category) AS n FROM sims),
    q AS (SELECT category, max(similarity) AS lim FROM r WHERE rn = round(0.99 * (n - 1)) + 1 GROUP BY 1)
    SELECT vec_id, s.category, round(similarity, 6) AS similarity FROM sims s JOIN q ON s.category = q.category
    WHERE similarity >= lim""", "categories")
def top_quantile(spark, sf):
    arrays, labels = sims(spark, sf)
    arrays = src.stored(arrays, "similarities")  # one matrix product, whatever is done with it
    return rounded(ve.top_quantile(ve.similarity_long(arrays, labels, "vec_id"), 0.99))


@query("best_label", SIMS + """, m AS (SELECT vec_id, max(similarity) AS top FROM sims GROUP BY 1)
    SELECT s.vec_id, min(category) AS category, round(max(similarity), 6) AS similarity
    FROM sims s JOIN m ON s.vec_id = m.vec_id AND similarity = top WHERE top > 0.1 GROUP BY s.vec_id""", "categories")
def best_label(spark, sf):
    return rounded(ve.best_label(*sims(spark, sf), "vec_id", 0.1))


@query("label_agreement", SIMS + """,
    m AS (SELECT label, list(a ORDER BY pos) AS mean FROM (
            SELECT label, pos, avg(v::DOUBLE) AS a FROM (
              SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS v FROM embeddings)
            GROUP BY ALL) GROUP BY label),
    a AS (SELECT vec_id, category FROM sims WHERE similarity >= 0.1),
    b AS (SELECT vec_id, m.label::VARCHAR AS category FROM embeddings e CROSS JOIN m
          WHERE list_cosine_similarity(e.embedding::DOUBLE[], m.mean) >= 0.1),
    f AS (SELECT coalesce(a.vec_id, b.vec_id) AS vec_id, coalesce(a.category, b.category) AS category,
                 (a.vec_id IS NOT NULL)::INT AS a, (b.vec_id IS NOT NULL)::INT AS b
          FROM a FULL JOIN b ON a.vec_id = b.vec_id AND a.category = b.category),
    k AS (SELECT * FROM f WHERE vec_id IN (SELECT vec_id FROM a) AND vec_id IN (SELECT vec_id FROM b)),
    c AS (SELECT category, coalesce(sum(a * b) / nullif(sum(a), 0), 0) AS ba,
                 coalesce(sum(a * b) / nullif(sum(b), 0), 0) AS ab FROM k GROUP BY 1),
    j AS (SELECT vec_id, sum(a * b) / count(*) AS j FROM k GROUP BY 1)
    SELECT (SELECT round(count(DISTINCT k.vec_id) / (SELECT count(DISTINCT vec_id) FROM a), 6) FROM k) AS overlap,
           (SELECT round(sum(ba) / 10, 6) FROM c) AS p_b_given_a, (SELECT round(sum(ab) / 10, 6) FROM c) AS p_a_given_b,
           (SELECT round(avg(j), 6) FROM j) AS jaccard""", "categories")
def label_agreement(spark, sf):
    pages = b.vectors(spark, sf)
    first = ve.read_labels(b.categories(spark, sf))
    mean = ve.read_labels(ve.label_means(pages))
    a, c = (
        ve.predicted_pairs(ve.predicted(ve.similarity_arrays(pages, n, "vec_id"), n, "vec_id", 0.1), "vec_id")
        for n in (first, mean)
    )
    flags = ag.label_flags(a, c, "vec_id")
    overlap = ag.set_overlap(a.select("vec_id"), c.select("vec_id"), "vec_id").select("share_of_a").scalar()
    cond = ag.conditional_probabilities(flags, "vec_id")
    n = len(first.names)
    jaccard = ag.with_jaccard(ag.paired_sets(flags, "a", "b", "vec_id"), "a", "b")
    means = cond.agg((F.sum("p_b_given_a") / n).alias("p_b_given_a"), (F.sum("p_a_given_b") / n).alias("p_a_given_b"))
    return rounded(means.select(
        overlap.alias("overlap"), "p_b_given_a", "p_a_given_b",
        jaccard.agg(F.avg("jaccard_similarity")).scalar().alias("jaccard")))


def hashed_sql(name: str, rows: str, key: str) -> str:
    """Views ``name`` (key, place, n) and ``name``_len (key, len) of hashed word counts."""
    return f"""{name}_w AS (SELECT {key}, unnest(regexp_extract_all(lower(text), '{W}+')) AS word FROM {rows}),
    {name} AS (SELECT {key}, ('0x' || substring(md5(word), 1, 8))::BIGINT % 384 AS place, count(*) AS n FROM {name}_w GROUP BY ALL),
    {name}_len AS (SELECT {key}, sqrt(sum(n * n)) AS len FROM {name} GROUP BY ALL)"""


@query("embed_hashing", ", " + hashed_sql("h", "page_text", "url") + """
    SELECT g.url, list(round(coalesce(n / len, 0), 6) ORDER BY g.place) AS embedding
    FROM (SELECT url, unnest(range(384)) AS place FROM page_text) g
    LEFT JOIN h ON h.url = g.url AND h.place = g.place LEFT JOIN h_len l ON l.url = g.url GROUP BY g.url""", "page_text")
def embed_hashing(spark, sf):
    vectors = ve.embed_hashing(b.page_text(spark, sf), "url")
    return vectors.withColumn("embedding", F.transform("embedding", lambda v: F.round(v, 6)))


# Names of the broad fields pages are compared with.
BROAD_FIELDS = [
    "Advanced materials and maufacturing",
    "Advanced information and communication technologies",
    "AI technologies",
    "Energy and environment",
    "Quantum",
    "Biotechnology, gene technology and vaccines",
    "sensing, timing and navigation",
    "Defence, space, robotics and transportation",
]


@query("similarity_broad_fields", ", " + hashed_sql("h", "page_text", "url") + f""",
    fields AS (SELECT unnest([{", ".join(f"'{f}'" for f in BROAD_FIELDS)}]) AS text), named AS (SELECT text AS label, text FROM fields),
    """ + hashed_sql("f", "named", "label") + """,
    near AS (SELECT h.url, f.label, sum(h.n * f.n) / (any_value(a.len) * any_value(z.len)) AS s
             FROM h JOIN f ON h.place = f.place JOIN h_len a ON a.url = h.url JOIN f_len z ON z.label = f.label GROUP BY ALL)
    SELECT p.url, coalesce(list(label ORDER BY label) FILTER (s >= 0.3), ['unknown']) AS predicted
    FROM page_text p LEFT JOIN near ON near.url = p.url GROUP BY p.url""", "page_text")
def similarity_broad_fields(spark, sf):
    """Broad fields per page, texts and field names embedded by the built-in encoder."""
    fields = spark.createDataFrame([(f, f) for f in BROAD_FIELDS], "label string, text string")
    labels = ve.read_labels(ve.embed_hashing(fields, "label"))
    pages = ve.embed_hashing(b.page_text(spark, sf), "url")
    return ve.predicted(ve.similarity_arrays(pages, labels, "url"), labels, "url", 0.3)


@query("pca_scores")
def pca_scores(spark, sf):
    arrays, _ = sims(spark, sf)
    return rounded(ve.pca_scores(arrays, "vec_id", 10))


@query("pca_norms", SIMS + """,
    c AS (SELECT category, avg(similarity) AS centre FROM sims GROUP BY 1)
    SELECT vec_id, round(sum((similarity - centre) * (similarity - centre)), 6) AS distance
    FROM sims s JOIN c ON s.category = c.category GROUP BY vec_id""", "categories")
def pca_norms(spark, sf):
    """Over all components the squared scores add up to the squared distance from the mean."""
    arrays, labels = sims(spark, sf)
    k = len(labels.names)
    scores = ve.pca_scores(arrays, "vec_id", k, scores=k)
    squares = sum((F.col(f"pc{i + 1}") * F.col(f"pc{i + 1}") for i in range(k)), F.lit(0.0))
    return rounded(scores.select("vec_id", squares.alias("distance")))


# Answers of a language model.


@query("llm_candidates", """
    SELECT id, category, n_unique FROM unique_kw WHERE source = 'web' AND n_unique >= 3
    AND id IN (SELECT id FROM hits WHERE source = 'pat')""", "unique_kw")
def llm_candidates(spark, sf):
    return lb.candidates(b.hits(spark, sf), 3)


# Firms with texts are the sources of documents; the ones chosen are those with a keyword hit.
PART_CHARS = 100_000
CHOSEN = MATCHED + f""", chosen AS (SELECT DISTINCT p.id FROM matched m JOIN page_text p ON m.url = p.url
      JOIN dictionary d ON d.keyword = m.keyword WHERE d.category = 'delta'),
    own AS (SELECT * FROM page_text WHERE id IN (SELECT id FROM chosen)),
    corpus AS ({grouped_sql("own", PART_CHARS)})"""
HEAD = lb.instructions({c: f"work with {p}" for c, p in b.KEYWORD_ROWS})


def chosen_texts(spark, sf):
    found = kw.attach_category(matches(spark, sf), dictionary(spark)).filter("category = 'delta'")
    return lb.corpus(b.page_text(spark, sf), kw.attach_firm(found, b.page_ids(spark, sf)), part_chars=PART_CHARS)


@query("llm_corpus", CHOSEN + " SELECT id, part, text FROM corpus WHERE text <> ''", "page_text dictionary")
def llm_corpus(spark, sf):
    return chosen_texts(spark, sf)


@query("llm_prompts", CHOSEN + f"""
    SELECT id, part, piece, '{HEAD}' || substring(text, piece * {PART_CHARS} + 1, {PART_CHARS}) AS prompt
    FROM (SELECT id, part, text, unnest(range(greatest(ceil(length(text) / {PART_CHARS}), 1)::BIGINT))::INTEGER AS piece
          FROM corpus WHERE text <> '')""", "page_text dictionary")
def llm_prompts(spark, sf):
    return lb.prompts(chosen_texts(spark, sf), HEAD, PART_CHARS)


def answers(spark, sf):
    """Answers as text: most JSON, every 10th a Python literal, every 17th cut off."""
    fields = b.llm_labels(spark, sf).groupBy("id").agg(F.sort_array(F.collect_list("category")).alias("fields"))
    json = F.to_json(F.struct(
        F.when(F.col("id") % 3 != 0, F.col("fields")[0]).alias("primary_field"), "fields",
        F.lit("None of it is True, see text").alias("explanation"), F.lit("High").alias("confidence"),
    ), {"ignoreNullFields": "false"})
    literal = F.replace(F.replace(json, F.lit('"'), F.lit("'")), F.lit("null"), F.lit("None"))
    text = F.when(F.col("id") % 17 == 0, F.substring(json, 1, 25)).when(F.col("id") % 10 == 0, literal).otherwise(json)
    return fields.select("id", text.alias("answer"))


ANSWERS = """, l AS (SELECT id, list_sort(list(category)) AS f FROM llm_labels GROUP BY id),
    a AS (SELECT id, CASE WHEN id % 17 <> 0 AND id % 3 <> 0 THEN f[1] END AS primary_field,
                 CASE WHEN id % 17 <> 0 THEN f END AS fields,
                 CASE WHEN id % 17 <> 0 THEN 'None of it is True, see text' END AS explanation,
                 CASE WHEN id % 17 <> 0 THEN 'High' END AS confidence FROM l)"""


@query("llm_answers_parse", ANSWERS + " SELECT * FROM a", "llm_labels")
def llm_answers_parse(spark, sf):
    return lb.parse_answers(answers(spark, sf))


@query("scalar_json", ANSWERS + " SELECT id, fields[1] AS first, len(fields)::BIGINT AS n FROM a", "llm_labels")
def scalar_json(spark, sf):
    fields = F.col("fields")
    return lb.parse_answers(answers(spark, sf)).select(
        "id", F.get(fields, F.lit(0)).alias("first"), F.size(fields).cast("long").alias("n"))


@query("llm_batch_parse", ANSWERS + """
    SELECT 'CHCHE' || lpad(id::VARCHAR, 9, '0') AS id, * EXCLUDE (id) FROM a""", "llm_labels")
def llm_batch_parse(spark, sf):
    message = F.struct(F.struct(F.col("answer").alias("content")).alias("message"))
    line = answers(spark, sf).select(
        F.concat(F.lit("CHCHE"), F.lpad(F.col("id").cast("string"), 9, "0"), F.lit("-1")).alias("custom_id"),
        F.struct(F.struct(F.array(message).alias("choices")).alias("body")).alias("response"))
    path = src.write_json(line, src.shared_folder(spark, "batch"))
    return lb.read_batch(spark, path)


@query("llm_check", ANSWERS + """
    SELECT a.id, primary_field, explanation, confidence, url FROM a
    JOIN (SELECT id, min(page) AS url FROM hits GROUP BY id) u ON a.id = u.id""", "llm_labels")
def llm_check(spark, sf):
    urls = fo.firm_url(b.hits(spark, sf).select("id", F.col("page").alias("url")))
    parsed = lb.parse_answers(answers(spark, sf)).drop("fields")
    return lb.check_table(parsed, urls)
