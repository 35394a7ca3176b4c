from pyspark.sql import functions as F

from plait.functions import last_observation, step


@step("evens", total="sum(id)", biggest=lambda: F.max("id"))
def evens(df):
    return df.where("id % 2 = 0")


def test_step_observes_rows_from_the_job(spark):
    out = evens(spark.range(10))
    assert evens.__name__ == "evens"                  # functools.wraps kept
    out.write.format("noop").mode("overwrite").save()
    m = last_observation("evens")
    assert m["rows"] == 5 and m["total"] == 20 and m["biggest"] == 8


def test_step_metrics_are_per_thread(spark):
    import threading
    results = {}

    def run(n):
        out = evens(spark.range(n))
        out.write.format("noop").mode("overwrite").save()
        results[n] = last_observation("evens")["rows"]

    threads = [threading.Thread(target=run, args=(n,)) for n in (10, 100)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert results == {10: 5, 100: 50}
