"""tallgrass: wide questionnaire tables to one long answer table, on Spark."""
