from __future__ import annotations

from datetime import datetime

from repopulse.operators.enrich import fetch_nodes, fetch_summary, flatten_nodes


def actors(spark, n):
    return spark.range(n).withColumnRenamed("id", "actor_id")


def test_requests_are_batched_and_failures_reported(spark):
    def lookup(node_ids):
        import base64

        users = [int(base64.b64decode(node_id).decode().removeprefix("04:User")) for node_id in node_ids]
        if len(users) > 10:
            raise AssertionError("request too large")
        if 13 in users:
            raise TimeoutError("no answer")
        return [None if user == 0 else f'{{"databaseId": {user}}}' for user in users]

    answers = fetch_nodes(actors(spark, 60), lookup, partitions=3, request_size=10)
    rows = answers.collect()
    assert sorted(r.actor_id for r in rows) == list(range(60))
    failed = [r for r in rows if r.status == "failed"]
    assert 13 in [r.actor_id for r in failed] and len(failed) <= 10
    assert {r.error for r in failed} == {"no answer"}
    # User 0 has no node; its request may be the one that failed.
    assert {r.actor_id: r.status for r in rows}[0] in ("missing", "failed")
    assert not any(r.status == "missing" for r in rows if r.actor_id)
    summary = {r.status: r.n_actors for r in fetch_summary(answers).collect()}
    assert sum(summary.values()) == 60
    found = [r.user_id for r in flatten_nodes(answers).collect()]
    assert sorted(found) == sorted(r.actor_id for r in rows if r.status == "found")


def test_users_without_a_node_are_missing(spark):
    answers = fetch_nodes(actors(spark, 4), lambda ids: [None] * len(ids), partitions=2)
    assert {r.status for r in answers.collect()} == {"missing"}
    assert flatten_nodes(answers).count() == 0


def test_short_answer_is_a_failure(spark):
    answers = fetch_nodes(actors(spark, 3), lambda ids: ["{}"], partitions=1)
    assert {r.status for r in answers.collect()} == {"failed"}


def test_flattening(spark):
    full = (
        '{"databaseId": 1, "login": "a", "followers": {"totalCount": 3}, "following": {"totalCount": 4},'
        ' "createdAt": "2020-01-01T00:00:00Z", "updatedAt": "2020-01-02T09:00:00+09:00"}'
    )
    bare = '{"databaseId": 2, "followers": null}'
    df = spark.createDataFrame([(full,), (bare,), (None,)], "node STRING")
    rows = {r.user_id: r for r in flatten_nodes(df).collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].followers_count, rows[1].following_count) == (3, 4)
    assert rows[1].user_created_at == datetime(2020, 1, 1)
    assert rows[1].user_updated_at == datetime(2020, 1, 2)
    assert (rows[2].followers_count, rows[2].following_count, rows[2].user_created_at) == (0, 0, None)
