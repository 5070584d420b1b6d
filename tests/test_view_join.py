"""One path for batches of every size."""

from driftwell.operators.vectors import view_losses


def test_small_batches_join_their_tile_counts(spark):
    rows = [(b, 2 * k + s, k, [1.0 + k, float(s)]) for b in (1, 2) for k in range(3) for s in (0, 1)]
    df = spark.createDataFrame(rows, "batch_id long, view_id long, pair_id long, embedding array<double>")
    one, many = view_losses(df), view_losses(df, tile_rows=2)
    assert "Join" in one._jdf.queryExecution().optimizedPlan().toString()
    a, b = ({(r.batch_id, r.view_id): (r.candidates, round(r.loss, 9)) for r in x.collect()} for x in (one, many))
    assert a == b and len(a) == len(rows)
