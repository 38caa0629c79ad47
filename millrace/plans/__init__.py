"""All registered queries; importing this package fills the registry."""

from millrace.plans import checking, contracting, drifting, evaluating, flagship, learning, observing, relating, searching, selecting, storing, streaming, texting  # noqa: F401
from millrace.plans.registry import REGISTRY, Query  # noqa: F401
