"""Randomised update/delete sequences against a plain-Python model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.table import delete_from_table, read_table, update_table, write_table

SCHEMA = "k long, v long, p string"

# (SQL condition, Python predicate returning True / False / None for NULL)
CONDITIONS = [
    ("v > 5", lambda r: None if r[1] is None else r[1] > 5),
    ("k % 3 = 0", lambda r: None if r[0] is None else r[0] % 3 == 0),
    ("p = 'a'", lambda r: None if r[2] is None else r[2] == "a"),
    ("p = 'b' AND v < 3", lambda r: _and(None if r[2] is None else r[2] == "b", None if r[1] is None else r[1] < 3)),
    ("v IS NULL", lambda r: r[1] is None),
]


def _and(a, b):
    if a is False or b is False:
        return False
    if a is None or b is None:
        return None
    return True


rows_strategy = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 20)),
        st.one_of(st.none(), st.integers(0, 10)),
        st.sampled_from(["a", "b", "c", None]),
    ),
    min_size=1,
    max_size=30,
)
ops_strategy = st.lists(
    st.tuples(st.sampled_from(["update", "delete", "move"]), st.integers(0, len(CONDITIONS) - 1)),
    min_size=1,
    max_size=3,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, ops=ops_strategy, partitioned=st.booleans())
def test_dml_matches_model(spark, tmp_path_factory, rows, ops, partitioned):
    path = "file://" + str(tmp_path_factory.mktemp("prop"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    write_table(df, path, partition_by=["p"] if partitioned else None)
    model = list(rows)
    for op, idx in ops:
        sql, pred = CONDITIONS[idx]
        before = len(model)
        if op == "update":
            update_table(spark, path, sql, {"v": "coalesce(v, 0) + 100"})
            model = [
                (r[0], (r[1] or 0) + 100, r[2]) if pred(r) is True else r for r in model
            ]
            assert len(model) == before
        elif op == "move":  # rewrites the partition column: rows change directories
            update_table(spark, path, sql, {"p": "'moved'"})
            model = [(r[0], r[1], "moved") if pred(r) is True else r for r in model]
        else:
            matching = sum(1 for r in model if pred(r) is True)
            delete_from_table(spark, path, sql)
            model = [r for r in model if pred(r) is not True]
            assert len(model) + matching == before
        got = sorted((tuple(r) for r in read_table(spark, path).collect()), key=repr)
        assert got == sorted(model, key=repr)
