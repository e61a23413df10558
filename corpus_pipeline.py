"""From documents to training documents, one stage after another."""

from sonomere.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
