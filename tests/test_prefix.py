from pyspark.sql import functions as F

from corpusmill.operators.prefix import prefix_cutoff, running_offsets


def test_running_offsets_matches_python(spark):
    rows = [(i, (i * 7) % 5) for i in range(300)]          # weights 0..4, zeros included
    df = spark.createDataFrame(rows, "k bigint, w bigint").repartition(9)
    got = {r["k"]: r["offset"] for r in running_offsets(df, ["k"], "w", num_ranges=13).collect()}
    acc, want = 0, {}
    for k, w in rows:
        want[k] = acc
        acc += w
    assert got == want


def test_prefix_cutoff_groups_and_empty_budget(spark):
    rows = [(g, (i * 2654435761) % (1 << 32), i, 1 + i % 3) for g in ("a", "b") for i in range(200)]
    df = spark.createDataFrame(rows, "g string, key bigint, tie bigint, w bigint")
    for budget in (0, 1, 57, 10 ** 9):
        got = sorted((r["g"], r["tie"]) for r in prefix_cutoff(df, ["g"], "key", "tie", "w", budget).collect())
        want = []
        for g in ("a", "b"):
            cum = 0
            for _, key, tie, w in sorted((x for x in rows if x[0] == g), key=lambda x: (x[1], x[2])):
                cum += w
                if cum > budget:
                    break
                want.append((g, tie))
        assert got == sorted(want), budget
