"""Order-margin, project, tonnage and sales-organisation analytics as Spark DataFrame jobs."""
