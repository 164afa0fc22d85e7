"""The same queries in plain SQL for DuckDB, written from the definitions.

They compare every pair, join without chunks and know nothing of profiles,
prefixes or blocks, so that they check those by other means.
"""

from __future__ import annotations

from tomewise.sources.documents import BOOK_TEXT_SQL

TARGET = 10
# The stop words, stated here on their own so that a change of the library's would show.
_STOP_WORDS = (
    "the", "and", "for", "are", "but", "not", "you", "all", "can", "her", "was", "one", "our", "out", "day",
    "get", "has", "him", "his", "how", "man", "new", "now", "old", "see", "two", "way", "who", "boy", "did",
    "its", "let", "put", "say", "she", "too", "use", "had", "may", "any", "from", "have", "that", "this",
    "with", "they", "will", "your", "about", "could", "there", "their", "which", "would", "these", "other",
    "than", "then", "them", "been", "into", "such", "only", "some", "time", "very", "what", "when", "where",
    "were",
)
_STOP_LIST = ", ".join(f"'{word}'" for word in _STOP_WORDS)
_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760]
_CODES += [*range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
_SPACES = " || ".join(f"chr({code})" for code in _CODES)

_BOOKS = f"books AS (SELECT doc_id, {BOOK_TEXT_SQL} AS text FROM documents)"


# The header patterns, in this dialect.
def _field(pattern: str) -> str:
    return f"nullif(trim(regexp_extract(substr(text, 1, 2000), '(?i){pattern}', 1)), '')"


_LINE = r":\s*(.+?)(?:\r?\n)"
_DATE = _field(r"Release Date:\s*(.+?)(?:\[|\n?$|\r?\n\r?\n)")
_YEAR = rf"CAST(nullif(regexp_extract({_DATE}, '\b(19\d\d|20\d\d)\b', 1), '') AS INTEGER)"

_META = f"""{_BOOKS}, meta AS (
  SELECT doc_id, {_field("Title" + _LINE)} AS title, {_DATE} AS release_date,
    {_YEAR} AS release_year, {_field("Language" + _LINE)} AS language,
    {_field("Character set encoding" + _LINE)} AS encoding
  FROM books)"""

_FOUND = rf"""{_BOOKS}, named AS (
  SELECT doc_id, {_YEAR} AS release_year,
    trim(regexp_replace({_field("Author" + _LINE)}, '\s*\[.*?\]\s*', '', 'g')) AS name
  FROM books), found AS (
  SELECT doc_id, CASE WHEN length(name) > 2 THEN name END AS author, release_year FROM named)"""

_COMPLETE = f"""{_FOUND}, complete AS (
  SELECT * FROM found WHERE author IS NOT NULL AND release_year IS NOT NULL)"""

_EDGES = f"""{_COMPLETE}, edges AS (
  SELECT e.author AS influencer, l.author AS influenced, e.release_year AS year_early,
    l.release_year AS year_late, l.release_year - e.release_year AS year_gap
  FROM complete e JOIN complete l
    ON e.author <> l.author AND l.release_year - e.release_year BETWEEN 1 AND 20
), author_edges AS (
  SELECT influencer, influenced, count(*) AS num_connections,
    min(year_gap) AS min_year_gap, max(year_gap) AS max_year_gap
  FROM edges GROUP BY ALL)"""

_METRICS = f"""{_EDGES}, outs AS (
  SELECT influencer AS author, count(*) AS out_degree FROM author_edges GROUP BY 1
), ins AS (
  SELECT influenced AS author, count(*) AS in_degree FROM author_edges GROUP BY 1
), metrics AS (
  SELECT author, coalesce(out_degree, 0) AS out_degree, coalesce(in_degree, 0) AS in_degree
  FROM outs FULL JOIN ins USING (author))"""

_MARKERS = f"""{_BOOKS}, marks AS (
  SELECT doc_id, text,
    strpos(lower(text), '*** start of this project gutenberg ebook') AS s1,
    strpos(lower(text), '*** start of the project gutenberg ebook') AS s2,
    strpos(lower(text), '*** end of this project gutenberg ebook') AS e1,
    strpos(lower(text), '*** end of the project gutenberg ebook') AS e2
  FROM books), starts AS (
  SELECT doc_id, text, CASE WHEN s1 > 0 THEN s1 + 41 WHEN s2 > 0 THEN s2 + 40 END AS after_mark,
    CASE WHEN e1 > 0 THEN e1 WHEN e2 > 0 THEN e2 ELSE length(text) + 1 END AS stop
  FROM marks), cuts AS (
  SELECT doc_id, text, stop, CASE WHEN after_mark IS NULL THEN 1
    WHEN strpos(substr(text, after_mark), chr(10)) = 0 THEN 1
    ELSE after_mark + strpos(substr(text, after_mark), chr(10)) END AS start
  FROM starts), bodies AS (
  SELECT doc_id, trim(substr(text, start, greatest(stop - start, 0)), {_SPACES}) AS body
  FROM cuts)"""

_CLEANED = r"regexp_replace(regexp_replace(lower({}), '[^a-z\s]', ' ', 'g'), '\s+', ' ', 'g')"

_WORDS = f"""split AS (
  SELECT doc_id, string_split({_CLEANED.format("text")}, ' ') AS parts FROM documents
), listed AS (
  SELECT doc_id, [w FOR w IN parts IF length(w) >= 3 AND w NOT IN ({_STOP_LIST})] AS words
  FROM split)"""

_COUNTS = f"""{_WORDS}, long AS (SELECT doc_id, unnest(words) AS word FROM listed), counts AS (
  SELECT doc_id, word, count(*) AS term_count FROM long GROUP BY ALL)"""

_WEIGHTS = f"""{_COUNTS}, lengths AS (
  SELECT doc_id, count(*) AS word_count FROM long GROUP BY 1
), tf AS (
  SELECT doc_id, word, term_count, word_count, term_count / word_count AS tf
  FROM counts JOIN lengths USING (doc_id)
), idf AS (
  SELECT word, count(*) AS doc_freq, ln((SELECT count(*) FROM documents) / count(*)) AS idf
  FROM counts GROUP BY word
), weights AS (
  SELECT doc_id, word, tf, idf, tf * idf AS tfidf FROM tf JOIN idf USING (word))"""

_PAIRS = f"""{_WEIGHTS}, norms AS (
  SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM weights GROUP BY 1
), dots AS (
  SELECT a.doc_id AS book1, b.doc_id AS book2, sum(a.tfidf * b.tfidf) AS dot
  FROM weights a JOIN weights b ON a.word = b.word AND a.doc_id < b.doc_id GROUP BY ALL
), exact AS (
  SELECT x.doc_id AS book1, y.doc_id AS book2,
    CASE WHEN x.norm * y.norm > 0 THEN coalesce(dot, 0) / (x.norm * y.norm) ELSE 0 END AS cosine
  FROM norms x JOIN norms y ON x.doc_id < y.doc_id
    LEFT JOIN dots ON book1 = x.doc_id AND book2 = y.doc_id
), pairs AS (SELECT book1, book2, round(cosine, 6) AS similarity FROM exact)"""


def _percent(count: str) -> str:
    share = f"CAST(100 * {count} AS DECIMAL(28, 6)) / count(*)"
    return f"CAST(round(CAST({share} AS DECIMAL(18, 6)), 1) AS DOUBLE)"


def _quality() -> str:
    lines = ["SELECT 'total' AS field, count(*) AS books, 100.0::DOUBLE AS percent FROM meta"]
    for field in ("title", "release_date", "release_year", "language", "encoding"):
        count = f"count({field})"
        lines.append(f"SELECT '{field}', {count}, {_percent(count)} FROM meta")
    return f"WITH {_META} " + " UNION ALL ".join(lines)


_TOP_OUT = "SELECT * FROM metrics ORDER BY out_degree DESC, author LIMIT 5"
_TOP_IN = "SELECT * FROM metrics ORDER BY in_degree DESC, author LIMIT 5"

ORACLES: dict[str, str] = {
    "word_count": r"""
        WITH kept AS (
          SELECT regexp_replace(lower(text), '[^a-z0-9\s\x0B]', '', 'g') AS line FROM documents
        ), long AS (SELECT unnest(regexp_split_to_array(line, '[ \t\n\r\f]+')) AS word FROM kept)
        SELECT word, count(*) AS count FROM long WHERE word <> '' GROUP BY word""",
    "file_name": r"""
        SELECT doc_id, regexp_extract(concat('file:/books/', source, '/', doc_id,
          CASE WHEN doc_id % 5 = 0 THEN '.html' ELSE '.txt' END), '([^/\\]+\.txt)$', 1) AS file_name
        FROM documents""",
    "metadata": f"WITH {_META} SELECT * FROM meta",
    "books_per_year": f"""WITH {_META} SELECT release_year, count(*) AS book_count FROM meta
        WHERE release_year IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "language_distribution": f"""WITH {_META} SELECT language, count(*) AS count FROM meta
        WHERE language IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1""",
    "most_common_language": f"""WITH {_META} SELECT language, count(*) AS count FROM meta
        WHERE language IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "title_lengths": f"""WITH {_META} SELECT doc_id, title, CAST(length(title) AS INTEGER)
        AS title_length FROM meta WHERE title IS NOT NULL""",
    "avg_title_length": f"""WITH {_META} SELECT round(avg(length(title)), 9) AS avg_title_length
        FROM meta""",
    "longest_titles": f"""WITH {_META} SELECT doc_id, title, CAST(length(title) AS INTEGER)
        AS title_length FROM meta WHERE title IS NOT NULL ORDER BY 3 DESC, 1 LIMIT 5""",
    "shortest_titles": f"""WITH {_META} SELECT doc_id, title, CAST(length(title) AS INTEGER)
        AS title_length FROM meta WHERE title IS NOT NULL ORDER BY 3, 1 LIMIT 5""",
    "quality_report": _quality(),
    "strip_boilerplate": f"WITH {_MARKERS} SELECT doc_id, body AS clean_text FROM bodies",
    "normalize_text": f"""WITH {_MARKERS} SELECT doc_id, {_CLEANED.format("body")} AS clean_text
        FROM bodies""",
    "tokens": f"""WITH {_WORDS} SELECT doc_id, array_to_string(words, ' ') AS words,
        CAST(len(words) AS INTEGER) AS word_count FROM listed""",
    "tokens_long": f"WITH {_WORDS} SELECT doc_id, unnest(words) AS word FROM listed",
    "doc_lengths": f"""WITH {_WORDS} SELECT doc_id, CAST(len(words) AS INTEGER) AS word_count
        FROM listed""",
    "corpus_stats": f"""WITH {_WORDS}, n AS (
          SELECT count(*) AS total, count(*) FILTER (len(words) > 0) AS found,
            CAST(sum(len(words)) AS BIGINT) AS total_words FROM listed)
        SELECT total AS total_books, found AS books_with_words, total_words,
          found * (found - 1) // 2 AS total_pairs FROM n""",
    "term_counts": f"WITH {_COUNTS} SELECT * FROM counts",
    "term_frequency": f"""WITH {_WEIGHTS} SELECT doc_id, CAST(word_count AS INTEGER) AS word_count,
        word, term_count, round(tf, 9) AS tf FROM tf""",
    "doc_frequency": f"WITH {_WEIGHTS} SELECT word, doc_freq FROM idf",
    "idf": f"WITH {_WEIGHTS} SELECT word, doc_freq, round(idf, 9) AS idf FROM idf",
    "tfidf": f"""WITH {_WEIGHTS} SELECT doc_id, word, round(tf, 9) AS tf, round(idf, 9) AS idf,
        round(tfidf, 9) AS tfidf FROM weights""",
    "top_terms_for_doc": f"""WITH {_WEIGHTS} SELECT word, round(tf, 9) AS tf, round(idf, 9) AS idf,
        round(tfidf, 9) AS tfidf FROM weights WHERE doc_id = {TARGET} ORDER BY 4 DESC, 1 LIMIT 20""",
    "top_terms_per_doc": f"""WITH {_WEIGHTS}, ranked AS (
          SELECT doc_id, word, round(tfidf, 9) AS tfidf, CAST(row_number() OVER (
            PARTITION BY doc_id ORDER BY round(tfidf, 9) DESC, word) AS INTEGER) AS rank
          FROM weights)
        SELECT doc_id, rank, word, tfidf FROM ranked WHERE rank <= 20""",
    "doc_vectors": f"""WITH {_WEIGHTS} SELECT doc_id, string_agg(
          concat(word, '=', CAST(round(tfidf * 1e9) AS BIGINT)), ' '
          ORDER BY concat(word, '=', CAST(round(tfidf * 1e9) AS BIGINT))) AS vector
        FROM weights GROUP BY doc_id""",
    "doc_norms": f"""WITH {_PAIRS} SELECT doc_id, round(norm, 9) AS norm FROM norms""",
    "cosine_pairs": f"WITH {_PAIRS} SELECT * FROM pairs",
    "similar_pairs": f"""WITH {_PAIRS} SELECT book1, book2, similarity FROM pairs
        WHERE similarity >= 0.5""",
    "avg_similarity": f"WITH {_PAIRS} SELECT round(avg(cosine), 9) AS avg_similarity FROM exact",
    "top_similar_to_doc": f"""WITH {_PAIRS}, mine AS (
          SELECT CASE WHEN book1 = {TARGET} THEN book2 ELSE book1 END AS other_book, similarity
          FROM pairs WHERE book1 = {TARGET} OR book2 = {TARGET})
        SELECT * FROM mine ORDER BY similarity DESC, other_book LIMIT 5""",
    "top_similar_pairs": f"""WITH {_PAIRS} SELECT * FROM pairs
        ORDER BY similarity DESC, book1, book2 LIMIT 20""",
    "authors": f"WITH {_FOUND} SELECT doc_id, author, release_year FROM found",
    "books_complete": f"WITH {_COMPLETE} SELECT doc_id, author, release_year FROM complete",
    "completeness": f"""WITH {_COMPLETE}, n AS (SELECT count(*) AS n FROM complete)
        SELECT n AS complete_books, (SELECT count(*) FROM found) - n AS incomplete_books FROM n""",
    "author_book_counts": f"""WITH {_COMPLETE} SELECT author, count(*) AS book_count
        FROM complete GROUP BY 1 ORDER BY 2 DESC, 1""",
    "author_count": f"""WITH {_COMPLETE} SELECT count(DISTINCT author) AS unique_authors
        FROM complete""",
    "top_authors_by_books": f"""WITH {_COMPLETE} SELECT author, count(*) AS book_count
        FROM complete GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "influence_book_edges": f"WITH {_EDGES} SELECT * FROM edges",
    "closest_edges": f"""WITH {_EDGES} SELECT * FROM edges
        ORDER BY year_gap, influencer, influenced, year_early LIMIT 20""",
    "influence_author_edges": f"WITH {_EDGES} SELECT * FROM author_edges",
    "influence_of_author": f"""WITH {_EDGES} SELECT * FROM author_edges
        WHERE influencer = 'Writer 10' OR influenced = 'Writer 10'""",
    "influence_totals": f"""WITH {_EDGES} SELECT (SELECT count(*) FROM edges) AS book_edges,
        (SELECT count(*) FROM author_edges) AS author_edges""",
    "strongest_edges": f"""WITH {_EDGES} SELECT * FROM author_edges
        ORDER BY num_connections DESC, influencer, influenced LIMIT 20""",
    "strongest_edges_per_author": f"""WITH {_EDGES}, ranked AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY influencer ORDER BY num_connections DESC, influenced)
            AS INTEGER) AS rank FROM author_edges)
        SELECT influencer, rank, influenced, num_connections, min_year_gap, max_year_gap FROM ranked
        WHERE rank <= 5""",
    "out_degree": f"WITH {_METRICS} SELECT * FROM outs",
    "in_degree": f"WITH {_METRICS} SELECT * FROM ins",
    "author_metrics": f"WITH {_METRICS} SELECT * FROM metrics",
    "top_out_degree": f"WITH {_METRICS} {_TOP_OUT}",
    "top_in_degree": f"WITH {_METRICS} {_TOP_IN}",
    "top_authors": f"WITH {_METRICS} ({_TOP_OUT}) UNION ({_TOP_IN})",
}
