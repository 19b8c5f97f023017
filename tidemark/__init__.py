"""tidemark: experience-quality scoring and monitoring on Spark.

Generic DataFrame / Structured Streaming / MLlib operators, parameterised by a
use-case spec (:mod:`tidemark.spec`).
"""

from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING, UseCase, use_case

__all__ = ["UseCase", "CLOUD_GAMING", "VIDEO_STREAMING", "use_case"]
