"""From raw documents to packed token windows, in five stages; they live with the operators they call."""

from momentlake.llm.pipeline import NEAR, ORACLE_SQL, STAGES, run

__all__ = ["NEAR", "ORACLE_SQL", "STAGES", "run"]
