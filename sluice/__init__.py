"""Table movement and change application as Spark DataFrame operators."""
