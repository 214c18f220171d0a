"""Question/answer dataset building and filtering over documents and knowledge graphs, on Spark."""
