"""Every operator as a query over the star-schema tables, with its SQL equivalent."""

from .registry import REGISTRY, SQL

from . import climate_queries  # noqa: F401
from . import community_queries  # noqa: F401
from . import correction_queries  # noqa: F401
from . import name_queries  # noqa: F401
from . import profile_queries  # noqa: F401
from . import quality_queries  # noqa: F401
from . import reshape_queries  # noqa: F401
from . import source_queries  # noqa: F401
from . import taxonomy_queries  # noqa: F401
from . import trait_queries  # noqa: F401

__all__ = ["REGISTRY", "SQL"]
