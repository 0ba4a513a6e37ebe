"""Landing text, bronze tables and landed-page audits."""
