import random

from pyspark.sql import functions as F

from docloom.llm.line_dedup import FEW, line_dedup


def test_similar_lines_meet_under_common_keys_alone(spark):
    """Lines of 20 characters with the same last third. Those of a pair differ in each of the other two, so nothing but that third, which is common, brings them together."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(n))
    lines = [word(13) + "common7" for _ in range(3 * FEW)]
    pairs = [lines[i][:3] + "a" + lines[i][4:9] + "e" + lines[i][10:] for i in range(10)]
    rows = [(i, t) for i, t in enumerate(lines)] + [(1000 + i, t) for i, t in enumerate(pairs)] + [(2000, "something else")]
    out = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), least_words=1)
    assert sorted(r.doc_id for r in out.where(F.col("n_removed") > 0).collect()) == [1000 + i for i in range(10)]
