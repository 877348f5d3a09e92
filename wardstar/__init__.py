"""wardstar: clinical star-schema building, cleaning and document retrieval on PySpark."""
