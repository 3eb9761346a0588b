"""lakeloom: document de-duplication, entity resolution and graph export as Spark plans."""
