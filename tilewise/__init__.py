"""Rectangle relations, overlap joins, audits and source adapters as Spark DataFrame operators."""
