"""Order cleaning, quality gates and sales marts as native Spark plans."""
