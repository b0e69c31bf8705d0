"""quotelens: market-price analytics for quote panels on Spark DataFrames.

Every public function takes and returns Spark DataFrames (or small scalar
records computed by one aggregate); nothing row-level passes through the
driver. See README.md for the operator map.
"""

from quotelens.spec import PanelSpec, TargetSpec, ConfigError, DataContractError
from quotelens.session import get_session, checkpoint_dir

__all__ = [
    "PanelSpec",
    "TargetSpec",
    "ConfigError",
    "DataContractError",
    "get_session",
    "checkpoint_dir",
]
