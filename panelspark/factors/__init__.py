"""Factor families as data: name -> expression over the measures of a panel."""
