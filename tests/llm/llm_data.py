"""Test documents."""

SCHEMA = "id string, doc_id long, text string, key string, n long, unit long, cls string, row string, score string"
SF_DIR = "/root/testdata/sf0.001"


def make_docs(spark, rows):
    """Documents with extra columns whose names an operator might use itself; some of them NULL."""
    return spark.createDataFrame(
        [(f"x{k}", i, t, None if k % 3 else "k", k, None, "c", "r", None) for k, (i, t) in enumerate(rows)], SCHEMA
    ).repartition(3)


def words(random_state, count, vocabulary=400):
    return " ".join(f"w{random_state.randrange(vocabulary)}" for _ in range(count))
