"""Filing, fact and transcript analytics expressed as Spark plans."""
