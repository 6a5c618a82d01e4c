"""Disk of the image copies: images of hot keys aren't copied for the blocks that they are compared with."""

from downfield.llm import media


def written(spark) -> int:
    """Bytes that all stages so far have written for shuffles."""
    jvm, none = spark._jvm, spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, none, jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def test_shuffled_bytes_do_not_grow_with_the_blocks(spark, data, monkeypatch):
    monkeypatch.setattr(media, "HOT", 0)
    images = media.vector_images(spark.read.parquet(f"{data}/embeddings.parquet").where("vec_id < 200")).cache()
    bodies = sum(len(r.points) for r in media.describe(images).collect())
    found, took = [], []
    for corners in (10**6, 400):  # one block or as many as cores, and about twenty
        monkeypatch.setattr(media, "BLOCK_CORNERS", corners)
        before = written(spark)
        found.append(sorted((r.media_id, r.component_id) for r in media.image_copies(images).collect()))
        took.append(written(spark) - before)
    assert found[0] == found[1]
    assert took[1] < took[0] + 3 * bodies, (took, bodies)
