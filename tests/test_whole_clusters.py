from archivolt.operators import conversations as conv


def test_large_cluster_gives_all_pairs(spark):
    clusters = spark.createDataFrame([(k, 0, 230) for k in range(230)] + [(500, 500, 1)], "node int, cluster int, size int")
    assert conv.cluster_pairs(clusters).count() == 230 * 229 // 2
