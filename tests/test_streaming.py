import os
import tempfile

from ruleweave.streaming.ntriples import class_counts_stream, subject_counts_stream

TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"


def test_streaming_counts_match_batch(spark):
    src = tempfile.mkdtemp(dir="/tmp")
    ck = tempfile.mkdtemp(dir="/tmp")
    with open(os.path.join(src, "part1.nt"), "w") as f:
        f.write(f"<http://e/a> <{TYPE}> <http://e/C> .\n# comment\n<http://e/a> <http://e/p> \"x\" .\n")
    with open(os.path.join(src, "part2.nt"), "w") as f:
        f.write(f"<http://e/b> <{TYPE}> <http://e/C> .\nbroken line\n")
    q = (subject_counts_stream(spark, src).writeStream.outputMode("complete").format("memory")
         .queryName("subj_counts").option("checkpointLocation", os.path.join(ck, "s")).start())
    q2 = (class_counts_stream(spark, src).writeStream.outputMode("complete").format("memory")
          .queryName("class_counts").option("checkpointLocation", os.path.join(ck, "c")).start())
    try:
        q.processAllAvailable()
        q2.processAllAvailable()
        subj = {r.s: r.n for r in spark.sql("select * from subj_counts").collect()}
        cls = {r["class"]: r.n for r in spark.sql("select * from class_counts").collect()}
    finally:
        q.stop()
        q2.stop()
    assert subj == {"http://e/a": 2, "http://e/b": 1}
    assert cls == {"http://e/C": 2}
