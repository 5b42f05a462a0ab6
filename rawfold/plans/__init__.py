"""Dataset specs and the builder/runner that turn them into Spark plans."""

from rawfold.plans.builder import build
from rawfold.plans.spec import Col, DatasetSpec, Fx, Key, Latest, Pick, SStar, Star, Tz
from rawfold.plans.specs import BY_NAME, SPECS

__all__ = ["BY_NAME", "Col", "DatasetSpec", "Fx", "Key", "Latest", "Pick", "SPECS", "SStar", "Star", "Tz",
           "build"]
