"""Session settings that follow from the size of the input."""

from __future__ import annotations

import math

MB = 1024 * 1024


def cluster_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a session that processes ``input_bytes`` on ``cores``.

    Shuffle partitions aim at 256 MB each and at no less than two per core. Beyond 50,000 of them the number of
    shuffle blocks (map tasks times partitions) costs more than larger partitions do, so partitions grow instead,
    and input splits grow with them. Adaptive execution merges partitions that turn out small.
    """
    partitions = min(50_000, max(2 * cores, math.ceil(input_bytes / (256 * MB))))
    split_mb = min(1024, max(128, math.ceil(input_bytes / MB / 100_000)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{128 * MB}",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{split_mb * MB}",
        "spark.sql.session.timeZone": "UTC",
    }
