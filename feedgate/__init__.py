"""feedgate: feed ingestion and data quality as Spark DataFrame operators."""

from feedgate.contract import Field, Rule, TableContract
from feedgate.session import configure, work_dir

__all__ = ["Field", "Rule", "TableContract", "configure", "work_dir"]
