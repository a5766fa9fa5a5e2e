"""quillspark: literature curation and hybrid retrieval as Spark plans."""
