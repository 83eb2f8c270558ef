"""DataFrame -> DataFrame operators: silver, marts, questions, quality, retrieval, evaluation."""
