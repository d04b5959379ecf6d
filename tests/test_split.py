import hashlib

from txrisk.operators import split


def side(key):
    return "train" if int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % 10 < 8 else "test"


def test_side_depends_on_the_key_alone(spark):
    df = spark.range(2000)
    marked = split.with_split(df.repartition(7), "id").collect()
    assert {r.id: r.split for r in marked} == {n: side(str(n)) for n in range(2000)}


def test_sides_partition_the_rows(spark):
    df = spark.createDataFrame([(n % 50 or None,) for n in range(1000)], "k BIGINT")
    train, test = split.hash_split(df, "k")
    assert train.count() + test.count() == 1000
    keys = [{r.k for r in part.distinct().collect()} for part in (train, test)]
    assert not keys[0] & keys[1] and None in keys[0] | keys[1]


def test_several_keys(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "a")], "x STRING, y STRING")
    found = {(r.x, r.y): r.split for r in split.with_split(df, "x", "y").collect()}
    assert found == {
        (x, y): side(f"{x or ''}\x1f{y or ''}") for x, y in [("a", "b"), ("a", None), (None, "a")]
    }


def test_random_split_is_seeded(spark):
    df = spark.range(5000, numPartitions=4)
    first, again = (split.random_split(df)[0] for _ in range(2))
    assert first.collect() == again.collect()
    assert abs(first.count() / 5000 - 0.8) < 0.03
