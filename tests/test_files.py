"""Reading files, writing results, and the four jobs on a folder of books."""

from __future__ import annotations

import csv
from collections import Counter
from itertools import combinations
from pathlib import Path

import pytest

from tests import corpus
from pyspark.sql import functions as F

from tomewise import sources
from tomewise.operators.wordcount import word_count
from tomewise.plans import jobs
from tomewise.plans.storage import scratch_dir, store, stored_tables


def write_books(folder: Path, texts: dict[str, str]) -> str:
    for name, text in texts.items():
        (folder / name).write_text(text, encoding="utf-8", newline="")
    return f"{folder}/*.txt"


def book(title, author, date, words):
    return (
        f"Title: {title}\r\nAuthor: {author}\r\nRelease Date: {date} [EBook #1]\r\n"
        "Language: English\r\n*** START OF THIS PROJECT GUTENBERG EBOOK ***\r\n"
        f"{words}\r\n*** END OF THIS PROJECT GUTENBERG EBOOK ***\r\nLicence\r\n"
    )


@pytest.fixture(scope="module")
def library(tmp_path_factory):
    texts = {
        "1.txt": book("One", "Ann", "May 1, 1990", "cat dog cat"),
        "2.txt": book("Two, \"Too\"", "Bob [Editor]", "May 1, 1995", "dog fish"),
        "10.txt": book("Ten", "Ann", "May 1, 2001", "cat dog bird"),
        "11.txt": "no header at all\n",
    }
    return write_books(tmp_path_factory.mktemp("library"), texts)


def csv_rows(path, single=False):
    files = sorted(Path(path).glob("part-*.csv"))
    assert len(files) == 1 if single else files
    return [row for f in files for row in csv.DictReader(f.open(encoding="utf-8"), escapechar="\\")]


def test_read_books(spark, library):
    rows = {r.file_name: r for r in sources.read_books(spark, library).collect()}
    assert set(rows) == {"1.txt", "2.txt", "10.txt", "11.txt"}
    assert rows["11.txt"].text == "no header at all\n"
    assert rows["1.txt"].file_path.endswith("/1.txt")
    assert sources.read_books(spark, library).columns == ["file_path", "text", "file_name"]


def test_require_unique(spark, library):
    books = sources.read_books(spark, library)
    assert sources.require_unique(books, "file_name") is books
    with pytest.raises(ValueError, match="on 2 rows"):
        sources.require_unique(books.union(books), "file_name")


def test_names_are_told_from_the_list_of_files(spark, library, tmp_path):
    sources.require_unique_names(spark, library)
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.txt").write_text("text")
    with pytest.raises(ValueError, match="'x.txt' is on 2 rows"):
        sources.require_unique_names(spark, f"{tmp_path}/*/*.txt")


def test_jobs_read_texts_once_and_leave_nothing(spark, library, tmp_path, monkeypatch):
    reads = spark.sparkContext.accumulator(0)

    def seen(text):
        reads.add(1)
        return text

    count = F.udf(seen, "string").asNondeterministic()
    monkeypatch.setattr(jobs, "read_books", lambda s, g: sources.read_books(s, g).withColumn("text", count("text")))
    work = tmp_path / "work"
    work.mkdir()
    for job in (jobs.profile_books, jobs.compare_books, jobs.map_influence):
        reads.value = 0
        job(spark, library, str(tmp_path / job.__name__), work=str(work))
        assert reads.value == 4
        assert list(work.iterdir()) == []


def test_stored_tables_go_when_a_job_fails(spark, tmp_path):
    with pytest.raises(ZeroDivisionError), stored_tables(spark, str(tmp_path)) as folder:
        store(spark.range(3), "numbers")
        assert len(list(Path(folder).iterdir())) == 1
        raise ZeroDivisionError
    assert list(tmp_path.iterdir()) == []


def test_split_size_is_used_and_restored(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("some words here\n" * 40_000)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    lines = sources.read_lines(spark, str(tmp_path / "lines.txt"))
    with sources.split_size(spark, 64 * 1024):
        assert lines.select("value").rdd.getNumPartitions() >= 10
        counts = {r["word"]: r["count"] for r in word_count(lines).collect()}
    assert counts == dict.fromkeys(["some", "words", "here"], 40_000)
    assert spark.conf.get(name) == before


def test_scratch_dir_must_be_set_on_a_cluster(spark, monkeypatch):
    context = type("Context", (), {"master": "yarn", "getCheckpointDir": lambda self: None})()
    conf = type("Conf", (), {"get": lambda self, name, default: default})()
    cluster = type("Session", (), {"sparkContext": context, "conf": conf})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(cluster)
    conf.get = None
    named = type("Conf", (), {"get": lambda self, name, default: "/shared"})()
    assert scratch_dir(type("Session", (), {"sparkContext": context, "conf": named})()) == "/shared"


def test_count_words(spark, library, tmp_path):
    jobs.count_words(spark, library, f"{tmp_path}/counts")
    lines = []
    for part in Path(f"{tmp_path}/counts").glob("part-*"):
        words = [line.split("\t") for line in part.read_text().splitlines()]
        assert words == sorted(words)
        lines += words
    counts = dict(lines)
    assert len(counts) == len(lines)
    assert counts["cat"] == "3" and counts["ebook"] == "9" and counts["1990"] == "1"


def test_profile_books(spark, library, tmp_path):
    jobs.profile_books(spark, library, str(tmp_path))
    years = csv_rows(tmp_path / "books_per_year.csv", single=True)
    assert [(r["release_year"], r["book_count"]) for r in years] == [
        ("1990", "1"),
        ("1995", "1"),
        ("2001", "1"),
    ]
    languages = csv_rows(tmp_path / "language_distribution.csv")
    assert [tuple(r.values()) for r in languages] == [("English", "3")]
    titles = csv_rows(tmp_path / "title_lengths.csv")
    assert {r["file_name"]: r["title_length"] for r in titles} == {
        "1.txt": "3",
        "2.txt": "10",
        "10.txt": "3",
    }
    meta = csv_rows(tmp_path / "complete_book_metadata.csv")
    assert {r["title"] for r in meta} == {"One", 'Two, "Too"', "Ten", ""}


def test_compare_books(spark, library, tmp_path):
    jobs.compare_books(spark, library, str(tmp_path), min_similarity=0.1, all_pairs=True)
    bodies = {"1.txt": "cat dog cat", "2.txt": "dog fish", "10.txt": "cat dog bird"}
    # "no", "at" are short and "all" is a stop word.
    bodies["11.txt"] = "header"
    want = corpus.cosines(corpus.weights(list(bodies.items())))
    scores = spark.read.parquet(f"{tmp_path}/tfidf_scores.parquet")
    assert scores.columns == ["file_name", "word", "tf", "idf", "tfidf"]
    assert scores.count() == 8
    pairs = spark.read.parquet(f"{tmp_path}/all_pairwise_similarities.parquet")
    assert pairs.schema["similarity"].dataType.simpleString() == "float"
    got = {(r.book1, r.book2): r.similarity for r in pairs.collect()}
    assert got.keys() == set(combinations(sorted(bodies), 2))
    for at, x in got.items():
        assert x == pytest.approx(want[at], abs=1e-6)
    nearest = csv_rows(tmp_path / "top_5_similar_to_10.csv", single=True)
    assert [r["other_book"] for r in nearest] == ["1.txt", "2.txt", "11.txt"]
    assert len(csv_rows(tmp_path / "top_20_similar_pairs.csv", single=True)) == 6
    similar = spark.read.parquet(f"{tmp_path}/similar_pairs.parquet").collect()
    assert {(r.book1, r.book2) for r in similar} == {at for at, x in want.items() if x >= 0.1}
    terms = csv_rows(tmp_path / "top_20_terms_of_10.csv", single=True)
    assert [r["word"] for r in terms] == ["bird", "cat", "dog"]
    average = csv_rows(tmp_path / "avg_similarity.csv", single=True)
    assert float(average[0]["avg_similarity"]) == pytest.approx(sum(want.values()) / len(want))


def test_compare_books_without_the_pair_table(spark, library, tmp_path):
    jobs.compare_books(spark, library, str(tmp_path))
    assert not (tmp_path / "all_pairwise_similarities.parquet").exists()
    assert (tmp_path / "top_20_similar_pairs.csv").exists()


def test_map_influence(spark, library, tmp_path):
    jobs.map_influence(spark, library, str(tmp_path))
    network = csv_rows(tmp_path / "author_influence_network.csv")
    assert sorted(tuple(r.values()) for r in network) == [
        ("Ann", "Bob", "1", "5", "5"),
        ("Bob", "Ann", "1", "6", "6"),
    ]
    metrics = csv_rows(tmp_path / "author_metrics.csv")
    assert sorted(tuple(r.values()) for r in metrics) == [("Ann", "1", "1"), ("Bob", "1", "1")]
    top = csv_rows(tmp_path / "top_authors.csv", single=True)
    assert Counter(r["author"] for r in top) == {"Ann": 1, "Bob": 1}


def test_map_influence_with_the_strongest_edges(spark, library, tmp_path):
    jobs.map_influence(spark, library, str(tmp_path), edges_per_author=1)
    assert not (tmp_path / "author_influence_network.csv").exists()
    edges = csv_rows(tmp_path / "strongest_edges_per_author.csv")
    assert sorted((r["influencer"], r["rank"], r["influenced"]) for r in edges) == [("Ann", "1", "Bob"), ("Bob", "1", "Ann")]
