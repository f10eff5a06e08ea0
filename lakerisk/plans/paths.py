"""Where the stored tables of a lake lie."""

from dataclasses import dataclass


@dataclass(frozen=True)
class LakePaths:
    """One folder per stored table under ``root``."""

    root: str

    def layer(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"
