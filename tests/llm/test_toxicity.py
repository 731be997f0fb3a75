import zlib

import numpy as np
from pyspark.sql import functions as F

from sessionweave.llm.toxicity import Lexicon, base_terms, label_model, scored, training_labels, votes, without_toxic


def test_scores_of_documents_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in scored(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for i, r in got.items())
    known = [(r.toxic, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    toxic = [p for t, p in known if t]
    assert sum(toxic) >= 0.7 * len(toxic)
    assert sum(p for t, p in known if not t) <= 0.02 * len(known)
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got.values())


def test_held_out_labels_change_nothing(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert training_labels(labels).where(held).count() == 0
    one, two = ({(r.doc_id, r.score) for r in scored(docs, x).collect()} for x in (labels, other))
    assert one == two


def test_voters():
    lexicon = Lexicon.of(base_terms() | {"abcd*"})
    clean, hit = votes("a quiet sentence", lexicon), votes("You IDIOT, you absolute m0ron!", lexicon)
    assert clean[0] == clean[1] == 0 and hit[1] == 1 and bin(hit[0]).count("1") >= 3
    assert votes("abcdefg", lexicon)[1] == 0 and votes("abcdefg abcdzz", lexicon)[1] == 2
    assert votes("stuuuupid", lexicon)[0] != 0 and votes("", lexicon) == (0, 0, 0, 0)


def test_label_model_learns_from_unlabelled_patterns():
    patterns = np.array([[0, 0], [1, 0], [0, 1], [1, 1]], float)
    counts = np.array([900, 20, 20, 60], float)
    labelled = np.array([[90, 1], [1, 1], [1, 1], [0, 6]], float)
    post = label_model(counts, patterns, labelled)
    assert post[0] < 0.2 and post[3] > 0.9 and post[3] > post[1] > post[0]


def test_odd_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, None), (4, 0, 1), (4, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = scored(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert scored(no_docs, labels).count() == 0
    assert scored(edge_docs, labels.limit(0)).count() == edge_docs.count()
