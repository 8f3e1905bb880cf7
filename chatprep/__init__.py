"""Chat data-set preparation and question/answer retrieval as Spark DataFrame plans.

Every public function takes and returns DataFrames (or Columns); options are
keyword arguments.  Sub-packages:

* ``functions`` - column expressions (text rules, facts, terms, conversations)
* ``sources``   - readers that give every record an explicit ``seq`` order key
* ``operators`` - DataFrame to DataFrame transforms
* ``sinks``     - JSON Lines, CSV and index writers
* ``plans``     - the user-level jobs built from the above
"""
