"""Wall time and shuffle bytes per query: python tests/measure.py [folder] [name..]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from bench import HEADLINE  # noqa: E402
from emberline.session import local_session  # noqa: E402


def shuffled(spark, first: int) -> tuple[int, int]:
    """Bytes written to shuffles by the stages numbered from ``first`` on, and the next number."""
    gateway = spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(
        None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    total, last = 0, first
    for i in range(stages.size()):
        s = stages.apply(i)
        if s.stageId() >= first:
            total, last = total + s.shuffleWriteBytes(), max(last, s.stageId() + 1)
    return total, last


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark, queries = local_session(), entry.queries()
    queries["run_summary"](spark, folder).write.format("noop").mode("overwrite").save()
    _, stage = shuffled(spark, 0)
    for name in sys.argv[2:] or HEADLINE:
        t = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        spent = time.perf_counter() - t
        size, stage = shuffled(spark, stage)
        print(f"| {name} | {spent:.2f} | {size / 1e6:.2f} |", flush=True)


if __name__ == "__main__":
    main()
